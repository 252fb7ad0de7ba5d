"""Substring deduplication and language-model scores against brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from samples import plain_words

from basketry.llm import lm_scoring, packed, substring_dedup, words


def removed(rows, window=13):
    first = {}
    for i, text in rows:
        own = plain_words(text)
        for k in range(len(own) - window + 1):
            key = tuple(own[k : k + window])
            first[key] = min(first.get(key, math.inf), math.inf if i is None else i)
    out = []
    for i, text in rows:
        own = plain_words(text)
        gone = [False] * len(own)
        for k in range(len(own) - window + 1):
            if first[tuple(own[k : k + window])] < (math.inf if i is None else i):
                gone[k : k + window] = [True] * window
        out.append((str(i), len(own), sum(gone), " ".join(w for w, g in zip(own, gone, strict=True) if not g)))
    return sorted(out)


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_repeats_equal_brute_force(request, table):
    docs = request.getfixturevalue(table)
    found = substring_dedup.remove_repeats(docs).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in found)
    assert got == removed([(r.doc_id, r.text) for r in docs.collect()])
    assert all(sum(s.end - s.start for s in r.repeats) == r.n_removed for r in found)


def test_hot_passage_among_many_documents(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"own{i} {passage} tail{i} " * (1 + i % 2)) for i in range(300)]
    found = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in found.collect())
    assert got == removed(rows)


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert lm_scoring.score(empty).count() == 0


def test_packing_round_trip():
    keys = np.unique(words.mix(np.arange(5000, dtype=np.uint64)))
    assert (packed.unpack(packed.pack(keys)) == keys).all()
    pieces = [keys[s:e] for _, s, e in packed.cut(keys, 4)]
    assert (np.concatenate(pieces) == keys).all()
    assert len(packed.unpack(packed.pack(keys[:0]))) == 0


def lowered(text):
    return plain_words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + ["\n"]


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_base_score_equals_brute_force(request, table):
    docs = request.getfixturevalue(table)
    rows = [(r.doc_id, lowered(r.text)) for r in docs.collect()]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    counts = Counter(w for i, own in rows if not held(i) for w in own)
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (
            str(i),
            held(i),
            len(own),
            sum(counts[w] > 0 for w in own),
            n,
            round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), 4),
        )
        for i, own in rows
    )
    got = sorted(
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
        for r in lm_scoring.score(docs).collect()
    )
    assert got == expected


def test_model_is_better_than_base_on_held_out_text(documents):
    rows = [r for r in lm_scoring.score(documents).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_probabilities_sum_to_one_and_score_is_their_product(spark):
    texts = ["a b a b a c", "a b c", "b a", "c c a b", "a b a", "b c a a", "x y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = [(i, lowered(t)) for i, t in enumerate(texts)]
    train = [own for i, own in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    single = Counter(w for own in train for w in own)
    pair = Counter(p for own in train for p in zip(["^", *own], own, strict=False))
    n, v = sum(single.values()), len(single)
    before = single | Counter({"^": len(train)})
    cells = Counter()
    for i, own in rows:
        crc = zlib.crc32(str(i).encode())
        if crc % 5 == 1 or crc // 5 % lm_scoring.DELETED_SHARE:
            continue
        rest, rest_pair, rest_before = single - Counter(own), pair.copy(), before.copy()
        rest_pair.subtract(zip(["^", *own], own, strict=False))
        rest_before.subtract([*own[:-1], "^"])
        rest_before["\n"] = 0
        for a, b in zip(["^", *own], own, strict=False):
            context = np.array([(single - Counter(own))[a] if a != "^" else len(train) - 1])
            cell = lm_scoring._cells(np.array([rest[b]]), np.array([rest_pair[a, b]]), context)
            cells[int(cell[0])] += 1
    weights = lm_scoring.learn_weights(sorted(cells.items()), n - sum(cells.values()), v)

    def chance(a, b):
        own = weights[int(math.log2(before[a] + 1))]
        return own[0] / (v + 1) + own[1] * single[b] / n + own[2] * pair[a, b] / max(before[a], 1)

    for a in ["^", *(w for w in single if w != "\n"), "never"]:
        total = sum(chance(a, b) for b in single) + chance(a, "never seen")
        assert math.isclose(total, 1, abs_tol=1e-9)
    for r in lm_scoring.score(docs).collect():
        own = rows[r.doc_id][1]
        expected = sum(math.log10(chance(a, b)) for a, b in zip(["^", *own], own, strict=False))
        assert math.isclose(r.score, expected, abs_tol=1e-6)


def test_counts_beyond_32_bits():
    docs = pa.table({"part": [0, 0], "doc_id": [1, 2], "text": ["a b a", "c"], "fold": [0, 0]})
    part = lm_scoring._Part(docs.set_column(0, "part", pa.array([0, 0], pa.int32())))
    own = lm_scoring._ask(part, 1)
    most = 2**32 - 1
    full = [packed.planes(np.full(len(packed.unpack(k)), most, np.uint32)) for k in own["keys"].to_pylist()]
    other = own.set_column(0, "part", pa.array([1] * len(own), pa.int32()))
    other = other.set_column(4, "counts", pa.array(full, pa.binary()))
    both = pa.concat_tables([own, other]).to_pylist()
    answers = []
    for key in {(r["bucket"], r["size"]) for r in both}:
        rows = [r for r in both if (r["bucket"], r["size"]) == key]
        answers.append(lm_scoring._answer(pa.Table.from_pylist(rows, own.schema)))
    told = pa.concat_tables(answers)
    counted = lm_scoring._counted(part, told.filter(pc.equal(told["part"], 0)), pa.int64()).to_pylist()
    sizes = {1: 4, 2: 2}
    expected = {1: [2, 1, 2, 2], 2: [1, 2]}
    for row in counted[:2]:
        got = lm_scoring._widened(row["single"], sizes[row["doc_id"]])
        assert got.tolist() == [most + n for n in expected[row["doc_id"]]]
        assert math.isclose(row["log_counts"], sum(math.log10(most + n + 0.5) for n in expected[row["doc_id"]]))


def test_weights_follow_the_held_out_cells():
    never, often = lm_scoring._NEVER, 5 << 16
    always_pair = [(often | 0 << 8 | never, 1000)]
    assert lm_scoring.learn_weights(always_pair, 10, 10)[5][2] > 0.9
    always_single = [(often | never << 8 | 40, 1000)]
    assert lm_scoring.learn_weights(always_single, 2000, 10)[5][1] > 0.9
