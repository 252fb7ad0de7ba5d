import re
from collections import Counter, defaultdict

import pytest

from basketry.llm import source_divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, min_docs, top):
    docs = [(lang or "", source or "", Counter(TERM.findall((text or "").translate(LOWER)))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        frequency = Counter(t for _, _, terms in own for t in terms)
        kept = sorted(t for t, n in frequency.items() if n >= min_docs)
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update({t: n for t, n in terms.items() if t in kept})
        every = sum(counts.values(), Counter())

        def share(of, term, kept=kept):
            return 1 + 10**9 * (of[term] + 5) // (sum(of.values()) + 5 * len(kept))

        for a in counts:
            pairs = [(b, sum(abs(share(counts[a], t) - share(counts[b], t)) for t in kept)) for b in counts if b != a]
            terms = [(t, share(counts[a], t) - share(every, t)) for t in kept if counts[a][t]]
            for part, found, limit in (("pair", pairs, None), ("term", [x for x in terms if x[1] > 0], top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, a, part, i, v, r) for r, (i, v) in enumerate(found[:limit], 1)]
    return sorted(out)


def audited(spark, rows, **options):
    docs = spark.createDataFrame(
        [(l, s, t, 1, "x") for l, s, t in rows], "lang string, source string, text string, n int, term string"
    )
    return sorted(tuple(r) for r in source_divergence.audit(docs, **options).collect())


ROWS = (
    [("en", f"s{i % 7}", f"alpha beta{i % 3} gamma_{i % 5}x Delta{'é' * (i % 2)}") for i in range(60)]
    # A third of all rows is one text, in many sources.
    + [("en", f"s{i % 9}", "the common text, the same") for i in range(60)]
    + [("de", "s1", "eins zwei"), ("de", None, "eins"), ("de", "", "zwei zwei"), ("de", "empty", None)]
    + [(None, "s1", "lone"), (None, "s2", ""), ("fr", "only", "seul seul")]
)


@pytest.mark.parametrize(
    "min_docs, top, sizes", [(1, 50, {"block": 2, "chunk_rows": 3}), (2, 2, {"block": 1, "chunk_rows": 1}), (1000, 50, {})]
)
def test_equals_brute_force(spark, min_docs, top, sizes):
    assert audited(spark, ROWS, min_docs=min_docs, top_terms=top, **sizes) == brute_force(ROWS, min_docs, top)


def test_long_and_shared_texts(spark, monkeypatch):
    monkeypatch.setattr(source_divergence, "_AT_ONCE", 5)
    long = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(4000))
    rows = [("en", f"s{i}", long) for i in range(6)] + [("en", "s0", long[: len(long) // 2]), ("en", "s9", "wab")]
    assert audited(spark, rows, min_docs=2) == brute_force(rows, 2, 50)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "lang string, source string, text string")
    assert source_divergence.audit(docs).count() == 0
