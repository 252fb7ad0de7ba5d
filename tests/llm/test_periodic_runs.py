import hashlib
import random
import zlib

import numpy as np
import pytest
from samples import SF_DIR, plain_words

from basketry.llm import periodic_runs, queries, words


def brute_force(own, least=12):
    """All runs as (start, length, period), by comparing the words of every distance."""
    found, n = [], len(own)
    numbers = np.unique(own, return_inverse=True)[1] if own else np.zeros(0, int)
    for q in range(1, n // 2 + 1):
        differ = np.flatnonzero(numbers[q:] != numbers[:-q])
        start = np.concatenate([[0], differ + 1])
        end = np.concatenate([differ, [n - q]]) + q
        for i in np.flatnonzero(end - start >= max(least, 2 * q)).tolist():
            found.append((int(start[i]), int(end[i] - start[i]), q))
    # Multiples of the smallest period give the same stretch again.
    return sorted(r for r in found if not any(s <= r[0] and r[0] + r[1] <= s + k and q < r[2] for s, k, q in found))


def collapsed(own, runs):
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    return " ".join(w for i, w in enumerate(own) if i not in gone)


def test_random_texts_equal_brute_force(monkeypatch):
    random.seed(5)
    for _ in range(150):
        texts = []
        for _ in range(random.randint(1, 5)):
            letters = "abcdefgh"[: random.choice([1, 2, 2, 3, 5, 8])]
            own = [random.choice(letters) for _ in range(random.randint(0, 60))]
            if own and random.random() < 0.6:
                p = random.randint(1, 8)
                own = own[5:9] + (own[:p] * 30)[: random.randint(5, 50)] + own[p : p + 20]
            texts.append(own)
        least = random.choice([2, 4, 5, 12])
        monkeypatch.setattr(periodic_runs, "TREE_WORDS", random.choice([1, 50, 10000]))
        got = words.Words([" ".join(t).encode() for t in texts])
        start, end, period = periodic_runs.find_runs(got, least)
        for i, own in enumerate(texts):
            mine = got.text_of[start] == i
            rows = zip(start[mine] - got.first[i], end[mine] - start[mine], period[mine], strict=True)
            assert [tuple(map(int, r)) for r in rows] == brute_force(own, least)


@pytest.mark.parametrize("text", ["abracadabra", "aaaaaa", "mississippi", "abcab"])
def test_common_beginnings(text):
    symbols = [ord(c) for c in text] + [500]
    common = periodic_runs.Common(*periodic_runs.Tree(symbols).tour(np.arange(501)))
    for i in range(len(text)):
        for j in range(i + 1, len(text)):
            k = 0
            while j + k < len(text) and text[i + k] == text[j + k]:
                k += 1
            assert common(np.array([i]), np.array([j]))[0] == k


def test_odd_rows(spark, odd):
    found = periodic_runs.detect(odd, carry=True).collect()
    assert len(found) == 11
    for row in found:
        own = plain_words(row.row.text)
        assert row.n_words == len(own) and row.doc_id == row.row.doc_id and row.row.part == 5
        runs = [(r.start, r.length, r.period) for r in row.runs]
        assert row.collapsed == collapsed(own, runs)
        if len(own) < 1000:
            assert runs == brute_force(own)
    assert periodic_runs.detect(odd.limit(0)).count() == 0


def test_long_text_that_repeats(spark):
    unit = [f"w{i % 701}" for i in range(1500)]
    text = " ".join(["start"] + unit * 9 + ["end"])
    [row] = periodic_runs.detect(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    runs = [tuple(r) for r in row.runs]
    assert (1, 13500, 1500) in runs and len(runs) > 9
    assert runs == brute_force(plain_words(text))


def test_query_equals_brute_force(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, SF_DIR).collect()}
    assert len(got) == len(documents)
    some = 0
    for doc in documents:
        own, h = plain_words(doc.text), zlib.crc32(str(doc.doc_id).encode())
        n, g = len(own), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            own = own[:a] + [own[a + (i - a) % p] for i in range(a, n)]
        row = got[doc.doc_id]
        runs = brute_force(own)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        some += bool(runs)
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        listed = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        assert row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(own, runs).encode()).hexdigest()
    assert some > 15
