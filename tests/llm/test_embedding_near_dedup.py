import math
from collections import defaultdict

import numpy as np
import pytest

from basketry.llm import embedding_near_dedup, queries

RNG = np.random.default_rng(3)


def near(vector, cosine):
    """A vector of this cosine to another."""
    other = RNG.normal(size=len(vector))
    other -= other @ vector / (vector @ vector) * vector
    return cosine * vector / np.linalg.norm(vector) + math.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def brute_force(rows, least=0.93):
    """Links and smallest reachable id of rows ``(id, vector, label)``, by comparing all of a label."""
    links, reach = defaultdict(int), {i: i for i, _, _ in rows}
    pairs = []
    for x, (i, a, label) in enumerate(rows):
        for y, (j, b, other) in enumerate(rows):
            if x != y and label == other and label is not None and a is not None and b is not None and len(a) == len(b):
                cosine = np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)) if any(a) and any(b) else 0
                if cosine >= least:
                    links[i] += 1
                    pairs.append((i, j))
    for _ in rows:
        for i, j in pairs:
            reach[i] = reach[j] = min(reach[i], reach[j])
    return {i: (links[i], reach[i], reach[i] == i) for i, _, _ in rows}


def found(spark, rows, **options):
    data = [(i, None if v is None else [float(x) for x in v], label, "x", 1) for i, v, label in rows]
    table = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, label string, node string, n int")
    got = embedding_near_dedup.near_duplicates(table, **options).collect()
    assert len(got) == len(rows)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}


def groups(count, size, width=24):
    rows = []
    for g in range(count):
        centre = RNG.normal(size=width)
        own = [centre, centre * 2, *[near(centre, 0.985) for _ in range(size - 2)]]
        rows += [(None, v, f"l{g % 2}") for v in own]
    rows += [(None, RNG.normal(size=width), f"l{g % 2}") for g in range(40)]
    order = RNG.permutation(len(rows)).tolist()
    return [(i, rows[k][1], rows[k][2]) for i, k in enumerate(order)]


@pytest.mark.parametrize("hashes, block", [(1, 512), (2, 7)])
def test_groups_equal_brute_force(spark, hashes, block):
    """Blocks smaller than a group: their pairs meet, none twice."""
    rows = groups(5, 12)
    assert found(spark, rows, hashes=hashes, block=block) == brute_force(rows)


def test_odd_rows(spark):
    a = RNG.normal(size=16)
    rows = [
        (1, a, "x"),
        (2, a, "x"),
        (3, a * 3, "x"),
        (4, a, "y"),
        (5, a, None),
        (6, None, "x"),
        (7, np.zeros(16), "x"),
        (8, [], "x"),
        (9, -a, "x"),
        (10, a[:8], "x"),
        (11, a[:8] * 2, "x"),
        (12, [5.0], "x"),
        (13, [7.0], "x"),
        (14, near(a, 0.5), "x"),
        (15, a * 1e200, "x"),
    ]
    assert found(spark, rows) == brute_force([(i, v if i != 15 else a, x) for i, v, x in rows])
    bad = [[math.nan, 1.0], [math.inf, 1.0], [None, 1.0], [1.0, None]]
    table = spark.createDataFrame(
        [(i, v, 1) for i, v in enumerate(bad * 2)] + [(None, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (90, [1.0, 2.0], 1)],
        "vec_id bigint, embedding array<float>, label int",
    )
    got = embedding_near_dedup.near_duplicates(table).collect()
    assert len(got) == 11 and all(r.n_links == 0 and r.component_id == r.vec_id and r.kept for r in got)


def test_repeated_rows_and_ids(spark):
    a, b = RNG.normal(size=16), RNG.normal(size=16)
    table = spark.createDataFrame(
        [(i, [float(x) for x in v], 0) for i, v in [(1, a), (1, a), (2, a), (1, b), (3, near(b, 0.99))]],
        "vec_id bigint, embedding array<double>, label int",
    )
    got = sorted(tuple(r) for r in embedding_near_dedup.near_duplicates(table).collect())
    # The two vectors of id 1 don't join the classes of 2 and 3 beyond that id.
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 1, False)]


def test_no_rows(spark):
    table = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert embedding_near_dedup.near_duplicates(table).count() == 0


@pytest.mark.parametrize("hashes", [1, 2, 3, 4])
def test_recall_near_the_threshold(hashes):
    """Pairs of cosine 0.93 to 0.95 share an own and a probed bucket, and most signs."""
    a = RNG.normal(size=(1500, 64))
    b = np.stack([near(v, RNG.uniform(0.93, 0.95)) for v in a])
    space = np.zeros(len(a), np.int64)
    x, y = embedding_near_dedup.padded(a), embedding_near_dedup.padded(b)
    p, q = (embedding_near_dedup.bucket_keys(v, space, hashes) for v in (x, y))
    met = (p[:, :, :1] == q).any((1, 2)) | (q[:, :, :1] == p).any((1, 2))
    differ = np.bitwise_count((embedding_near_dedup.signs(x) ^ embedding_near_dedup.signs(y)).view(np.uint64)).sum(1)
    assert (met & (differ <= embedding_near_dedup.MAX_DIFFERENT)).mean() >= 0.9


def test_transform_keeps_lengths():
    x = RNG.normal(size=(5, 32)).astype(np.float32)
    assert np.allclose(np.linalg.norm(embedding_near_dedup.turn(x, 7), axis=1), np.linalg.norm(x, axis=1), rtol=1e-5)


def test_query_equals_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    expected = brute_force([(r.vec_id, r.embedding, r.label) for r in table])
    got = queries.op12_embedding_near_dedup(spark, "/root/testdata/sf0.001").collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == expected
