"""Near-duplicate classes against brute force."""

import hashlib
import itertools
import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from samples import plain_words

from basketry import shared
from basketry.llm import near_dedup


def shingles(text):
    own = plain_words(text)
    return frozenset(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))) if own else frozenset()


def expected_classes(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    text = {i: t or "" for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, own in sets.items():
        for s in own:
            holders[s].append(i)
    pairs = {p for own in holders.values() for p in itertools.combinations(own, 2)}
    by_text = defaultdict(list)
    for i, t in text.items():
        by_text[t].append(i)
    pairs |= {p for own in by_text.values() for p in itertools.combinations(own, 2)}
    for a, b in pairs:
        union = len(sets[a] | sets[b])
        if text[a] == text[b] or len(sets[a] & sets[b]) >= 0.8 * union:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("block", [4, 256])
def test_classes_equal_brute_force(documents, block):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    found = near_dedup.classes(documents, block=block).collect()
    assert {r.doc_id: r.class_id for r in found} == expected_classes(rows)
    assert len(found) == len(rows)


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = near_dedup.classes(odd).collect()
    assert {r.doc_id: r.class_id for r in found} == expected_classes(rows)
    assert len(found) == len({i for i, _ in rows if i is not None})


def test_hot_group_of_near_copies_in_small_blocks(spark):
    """A third of all rows are near copies of one text, many of them unlike its smallest id."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(120):
        own = list(base)
        for _ in range(rng.randrange(5)):
            own[rng.randrange(80)] = f"r{rng.random()}"
        rows.append((i, " ".join(own)))
    rows += [(i, " ".join(f"o{rng.random()}" for _ in range(40))) for i in range(120, 360)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = near_dedup.classes(docs, block=8).collect()
    assert {r.doc_id: r.class_id for r in found} == expected_classes(rows)


def test_groups_of_long_texts_are_cut_by_their_bytes(spark):
    """Few enough texts for one block, but 10 MB of shingles."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(20_000)]
    rows = []
    for i in range(60):
        own = list(base)
        for at in rng.sample(range(20_000), rng.randrange(200)):
            own[at] = f"r{i}_{at}"
        rows.append((i, " ".join(own)))
    folder = Path(shared.shared_dir(spark).removeprefix("file://")) / "basketry"
    before = set(folder.glob("blocks-*"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = near_dedup.classes(docs).collect()
    assert {r.doc_id: r.class_id for r in found} == dict.fromkeys(range(60), 0)
    (blocks,) = set(folder.glob("blocks-*")) - before
    held = spark.read.parquet(str(blocks)).groupBy("centre", "block").count().agg({"count": "max"}).first()[0]
    assert held * 20_000 * 8 < 8_000_000


@pytest.mark.parametrize("block_bytes", [1, 4000])
def test_blocks_cut_by_bytes_lose_no_link(documents, block_bytes):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    found = near_dedup.classes(documents, block_bytes=block_bytes).collect()
    assert {r.doc_id: r.class_id for r in found} == expected_classes(rows)


def test_no_documents(spark):
    assert near_dedup.classes(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(1, 60)] + [(100, 200)], "a bigint, b bigint")
    found = {r["id"]: r["class"] for r in near_dedup.components(edges).collect()}
    assert found == {i: 1 for i in range(1, 61)} | {100: 100, 200: 100}


def probability_jaccard(a, b):
    total = 0
    for d in a.keys() & b.keys():
        total += 1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys())
    return total


def test_registers_agree_with_the_probability_jaccard():
    a = {i: 1 + i % 3 for i in range(60)}
    b = {i: 1 + i % 2 for i in range(20, 80)}
    sets = [(np.array(list(x), np.uint64) * np.uint64(7919), np.array(list(x.values()))) for x in (a, b)]
    signature = near_dedup.signatures(sets, 4096)
    share = float((signature[0] == signature[1]).mean())
    assert abs(share - probability_jaccard(a, b)) < 0.03


def test_repeated_lines_do_not_hide_alike_sets(spark):
    """Copies of a text that repeat one of its lines often have alike sets, but unlike counts."""
    rows = []
    for n, times in enumerate((20, 40, 100, 200, 400, 800)):
        for copy in range(4):
            own = [f"t{n}_{copy}_{i}" for i in range(300)]
            rows.append((len(rows), " ".join(own)))
            rows.append((len(rows), " ".join(own + own[100:110] * times)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = expected_classes(rows)
    assert len(set(expected.values())) == len(rows) // 2
    assert {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()} == expected


def test_texts_without_repeats_have_the_same_bands_either_way():
    sets = near_dedup.shingles([" ".join(f"w{i}" for i in range(60)).encode(), b"a b c d e " * 20])
    keys = near_dedup.candidate_keys(sets, 32, 4)
    weighted = near_dedup.band_keys(near_dedup.signatures(sets, 128)).tolist()
    assert keys[0] == weighted[0] and keys[1][:32] == weighted[1] and len(keys[1]) > 32


def test_two_texts_of_one_id_join_no_classes(spark):
    """The second text of id 1 is like that of id 3, but id 1 stands for its first."""
    a, b = (" ".join(f"{x}{i}" for i in range(200)) for x in "ab")
    for swapped in (False, True):
        first, second = (b, a) if swapped else (a, b)
        rows = [(1, first), (2, first + " x"), (1, second), (3, second + " y")]
        found = near_dedup.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        # The text of the smaller digest counts.
        smaller = min((first, second), key=lambda t: hashlib.md5(t.encode()).digest())
        partner = next(i for i, t in rows[1::2] if t.startswith(smaller))
        assert {r.doc_id: r.class_id for r in found} == {1: 1, 2: 2, 3: 3} | {partner: 1}
