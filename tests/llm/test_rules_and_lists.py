"""Quality rules, URL lists and decontamination."""

import hashlib
import re
from collections import Counter
from datetime import date

import pytest
import xxhash
from samples import PROSE, SF_DIR, plain_words

from basketry.llm import decontamination, quality_rules, queries, url_filters


def base(text):
    own = plain_words(text)
    lines = [x for x in (text or "").split("\n") if plain_words(x)]
    windows = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    count = Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 5)}
    failed = len(own) < 10 or 100 * len(covered) > 20 * len(own)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(covered), failed


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_base_counts_equal_brute_force(request, spark, labels, table):
    docs = request.getfixturevalue(table)
    own_labels = labels if table == "odd" else spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rated = quality_rules.rate(docs, own_labels, buckets=1 << 10).collect()
    got = sorted(
        (str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in rated
    )
    assert got == sorted((str(r.doc_id), *base(r.text)) for r in docs.collect())
    assert not any(r.kept and r.base_failed for r in rated)


def test_likelihood_ratio_parts_trusted_from_junk(spark):
    good = [(i, f"{PROSE} {i}") for i in range(40)]
    junk = [(100 + i, " ".join(f"x{j}%%%" for j in range(20)) + f" {i}") for i in range(20)]
    docs = spark.createDataFrame(good + junk, "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, 1) for i in range(30)] + [(100, 0)], "doc_id bigint, quality int")
    kept = {r.doc_id: r.kept for r in quality_rules.rate(docs, marks).collect()}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in junk)
    filtered = quality_rules.rate(docs, marks, carry=True).where("kept").select("row.*")
    assert filtered.columns == docs.columns and filtered.count() == len(good)


def test_weights_without_trust_or_rows(spark, odd, labels):
    none = labels.limit(0)
    assert {r.score for r in quality_rules.rate(odd, none, buckets=64).collect()} == {0.0}
    assert quality_rules.rate(odd.limit(0), labels, buckets=64).count() == 0


def test_quality_rules_run_without_python(spark):
    plan = queries.op3_quality_rules(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_score_is_the_mean_weight_and_no_array_of_features_is_kept(spark, odd, labels):
    own = odd.select("doc_id", "text").withColumn("words", quality_rules.words_of(odd["text"]))
    table = quality_rules.bucket_weights(quality_rules.hashed(own), labels, buckets=64)
    rated = quality_rules.rate(odd, labels, buckets=64)

    def mean(text):
        hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in plain_words(text)]
        pairs = [
            xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))
            for a, b in zip(hashes, hashes[1:])
        ]
        return sum(table[g % 64] for g in hashes + pairs) / max(1, len(hashes + pairs))

    expected = sorted((str(r.doc_id), mean(r.text)) for r in odd.collect())
    got = sorted((str(r.doc_id), r.score) for r in rated.collect())
    assert any(table) and [i for i, _ in got] == [i for i, _ in expected]
    assert [x for _, x in got] == pytest.approx([x for _, x in expected], abs=2e-6)
    assert "features" not in rated._jdf.queryExecution().optimizedPlan().toString()


LIST = [
    ("bad.example", "spam", date(2024, 1, 10), "add"),
    ("bad.example", "spam", date(2024, 1, 20), "drop"),
    ("bad.example", "spam", date(2024, 1, 20), "add"),
    ("sub.bad.example", "phishing", date(2024, 1, 15), "add"),
    ("sub.bad.example", "phishing", date(2024, 1, 15), "add"),
    ("other.example", "spam", date(2024, 1, 5), "add"),
    (None, "spam", date(2024, 1, 5), "add"),
    ("third.example", None, date(2024, 1, 5), "add"),
    ("fourth.example", "spam", None, "add"),
]


def judged(spark, captures):
    entries = spark.createDataFrame(LIST, "domain string, category string, day date, action string")
    rows = spark.createDataFrame(captures, "url string, fetched date, listed string, category string")
    return {(r.url, r.fetched): (r.listed, r.categories, r.blocked) for r in url_filters.judge(rows, entries).collect()}


def test_entries_hold_from_their_day_until_they_are_dropped(spark):
    url = "https://user@Sub.Bad.Example.:8080/x?y=http://other.example/"
    got = judged(spark, [(url, date(2024, 1, d), "?", "?") for d in (9, 10, 15, 19, 20, 21)])
    assert got == {
        (url, date(2024, 1, 9)): ("", "", False),
        (url, date(2024, 1, 10)): ("bad.example", "spam", True),
        (url, date(2024, 1, 15)): ("sub.bad.example", "phishing,spam", True),
        (url, date(2024, 1, 19)): ("sub.bad.example", "phishing,spam", True),
        (url, date(2024, 1, 20)): ("sub.bad.example", "phishing", True),
        (url, date(2024, 1, 21)): ("sub.bad.example", "phishing", True),
    }


def test_odd_captures(spark):
    day = date(2024, 2, 1)
    urls = [None, "", "mailto:x@other.example", "http://", "http://notother.example/", "http://other.example"]
    got = judged(spark, [(u, day, None, None) for u in urls] * 2 + [("http://other.example", None, None, None)])
    blocked = {k for k, v in got.items() if v[2]}
    assert blocked == {("http://other.example", day)}
    assert judged(spark, []) == {}


def test_hosts_of_many_labels(spark):
    day = date(2024, 2, 1)
    many = "a." * 300
    entries = spark.createDataFrame(
        [("evil.example", "spam", day, "add"), (many + "long.example", "long", day, "add"), ("example", "top", day, "add")],
        "domain string, category string, day date, action string",
    )
    hosts = [many + "evil.example", many + "long.example", "b." + many + "long.example", many[2:] + "long.example", "example"]
    rows = spark.createDataFrame([(f"http://{h}/", day) for h in hosts], "url string, fetched date")
    got = {r.host: r.categories for r in url_filters.judge(rows, entries).collect()}
    assert got == dict(zip(hosts, ["spam", "long", "long", "", "top"], strict=True))
    assert {r.blocked for r in url_filters.judge(rows, entries.limit(0)).collect()} == {False}


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contaminated(rows, items):
    windows = {}
    for name, text in items:
        own = words_of(text)
        n = min(10, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            windows.setdefault(tuple(own[i : i + n]), set()).add("" if name is None else str(name))
    out = []
    for i, text in rows:
        own, hit, found = words_of(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(own) - n + 1):
                if names := windows.get(tuple(own[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(i), len(own), len(hit), len(found), digest, bool(hit)))
    return sorted(out)


def test_decontamination_query_equals_brute_force(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted((str(r[0]), *r[1:]) for r in queries.op6_decontamination(spark, SF_DIR).collect())
    assert got == contaminated([(r.doc_id, r.text) for r in documents.collect()], items)


@pytest.mark.parametrize("most", [0, 100])
def test_decontamination_of_odd_rows(spark, odd, most):
    items = [(1, PROSE[10:]), (1, PROSE[10:]), (2, "w5 V5"), (3, None), (4, "!!"), (None, "END"), (5, "ünï")]
    bench = spark.createDataFrame(items, "item_id int, text string")
    scanned = decontamination.scan(odd, bench, max_broadcast=most, carry=True).collect()
    got = sorted(
        (
            str(r.doc_id),
            r.n_words,
            sum(s.end - s.start for s in r.spans),
            len(r["items"]),
            hashlib.sha256(",".join(r["items"]).encode()).hexdigest(),
            bool(r.spans),
        )
        for r in scanned
    )
    assert got == contaminated([(r.doc_id, r.text) for r in odd.collect()], items)
    assert all(r.row.text is None or not r.spans or len(r.clean) < len(r.row.text) for r in scanned)
    assert all("END" not in (r.clean or "") for r in scanned)


def test_decontamination_of_empty_tables(spark, odd):
    bench = spark.createDataFrame([], "item_id int, text string")
    assert {len(r.spans) for r in decontamination.scan(odd, bench).collect()} == {0}
    assert decontamination.scan(odd.limit(0), bench).count() == 0
