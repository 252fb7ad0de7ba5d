"""Personal data by a semi-Markov conditional random field over base rules.

Personal data needs a digit or an at sign, so a text is cut into islands: runs of neighbouring
words that hold one.  The base rules are applied to the islands and their spans always stay.
An island is then segmented: every segment of at most ``MAX_ATOMS`` atoms gets a score for each
kind from features of the whole span, and a dynamic program over segments chooses boundaries
and kinds together.  Its spans that touch no base span are added.

The field is trained by maximum likelihood on a bounded number of islands of the corpus, an equal
share of every kind and of islands without any as far as there are so many, which the base rules
label, and on copies of them that the rules miss (phone numbers without their country code).
Islands of ``MAX_LEARNED`` characters or more, tables of numbers for the most part, don't train it.

Defined results: a null or empty text has no spans; without islands to learn from nothing is
added; overlapping base spans of different kinds all stay; repeated rows are judged alike.
"""

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry import shared
from basketry.llm import words

shared.ship(__name__)

KINDS = ("email", "ip", "card", "phone")
#: Islands that the field learns from, in turn the first of every kind by a hash of their text.
MAX_TRAINING = 800
EPOCHS = 5
MAX_ATOMS = 16
#: Atoms of an island whose candidates are scored together, and feature names that a task remembers.
STEP_ATOMS = 2048
MAX_NAMES = 100_000
#: Islands of so many characters or more are found and segmented, but the field doesn't learn from them.
MAX_LEARNED = 200
_BUCKETS = 512

_SIGN = re.compile("[0-9@]")
_REST = re.compile(r"\S*")
_NEXT = re.compile(r"\x20+(?:[().-]+\x20+)*(?=\S)")
_LOCAL = re.compile("[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ATOM = re.compile(r"[A-Za-z]+|[0-9]+|\x20+|[^A-Za-z0-9\x20]")
_NOT_DIGIT = re.compile("[^0-9]")


def islands(text: str):
    """(start, end) of runs of words with a digit or an at sign, with brackets in between."""
    at = 0
    while found := _SIGN.search(text, at):
        start = found.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = _REST.match(text, found.start()).end()
        while step := _NEXT.match(text, end):
            stop = _REST.match(text, step.end()).end()
            if not _SIGN.search(text, step.end(), stop):
                break
            end = stop
        yield start, end
        at = end


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _valid_ip(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(p.isdigit() and len(p.lstrip("0")) < 4 and int(p[-4:]) < 256 for p in parts)


def _valid_card(text: str) -> bool:
    digits = _NOT_DIGIT.sub("", text)
    return 16 <= len(digits) <= 19 and passes_luhn(digits)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base rules, by kind and start."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            done = domain.end()
            out.append(("email", start, done))
        at = text.find("@", max(at + 1, done))
    out += [("ip", *m.span()) for m in _IP.finditer(text) if _valid_ip(m[0])]
    out += [("card", *m.span()) for m in _CARD.finditer(text) if _valid_card(m[0])]
    out += [
        ("phone", *m.span())
        for m in _PHONE.finditer(text)
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15
    ]
    return out


def _shape(text: str) -> str:
    return re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", lambda m: str(min(len(m[0]), 20)) + "d", text))


def _number(name: str) -> int:
    """Feature number of a name (FNV hash)."""
    value = 2166136261
    for byte in name.encode():
        value = (value ^ byte) * 16777619 & 0xFFFFFFFF
    return value % _BUCKETS


def _side(text: str, at: int) -> str:
    if not 0 <= at < len(text) or text[at].isspace():
        return "-"
    return "d" if text[at].isdigit() else "a" if text[at].isalpha() else text[at]


def span_features(text: str, start: int, end: int, cache: dict) -> list[int]:
    """Numbers of the features of a whole span; ``cache`` keeps those of names."""
    span = text[start:end]
    digits = _NOT_DIGIT.sub("", span)
    n = len(digits)
    named = [
        "bias",
        "shape " + _shape(span)[:40],
        f"digits {n if n < 21 else 21}",
        f"dots {min(span.count('.'), 5)}",
        f"at {min(span.count('@'), 2)}",
        f"first {_side(span, 0)}",
        f"last {_side(span, len(span) - 1)}",
        f"before {_side(text, start - 1)}",
        f"after {_side(text, end)}",
        f"space {' ' in span}",
        f"letters {any(c.isalpha() for c in span)}",
        f"luhn {16 <= n <= 19 and passes_luhn(digits)}",
        f"ip {_valid_ip(span)}",
        f"domain {bool(_DOMAIN.search(span))}",
    ]
    return [cache.get(x) or cache.setdefault(x, _number(x)) for x in named]


def _bounds(text: str) -> list[int]:
    """Where atoms begin, and the end."""
    return [0, *(m.end() for m in _ATOM.finditer(text))]


def _segments(text: str, bounds: list[int], cache: dict, first: int = 0, last: int | None = None) -> list:
    """(first atom, last atom + 1, features) of every candidate that begins with atoms ``first`` to ``last``."""
    out = []
    for i in range(first, len(bounds) - 1 if last is None else last):
        if text[bounds[i]] == " ":
            continue
        for j in range(i + 1, min(i + MAX_ATOMS, len(bounds) - 1) + 1):
            if text[bounds[j] - 1] != " " and _SIGN.search(text, bounds[i], bounds[j]):
                out.append((i, j, span_features(text, bounds[i], bounds[j], cache)))
    return out


def _scores(segments: list, weights: np.ndarray) -> np.ndarray:
    if not segments:
        return np.zeros((0, len(KINDS)))
    return weights[np.array([f for _, _, f in segments])].sum(1)


def decode(text: str, weights: np.ndarray, cache: dict) -> list[tuple[str, int, int]]:
    """The best segmentation of an island.

    Candidates are scored for ``STEP_ATOMS`` first atoms at a time, so that an island of any length
    takes little more memory than its text; those that end by the next step's first atom all
    begin before it, so the program over ends goes on as if it had them all.
    """
    bounds = _bounds(text)
    atoms = len(bounds) - 1
    best, back = [0.0] * (atoms + 1), {}
    ending = defaultdict(list)
    for first in range(0, atoms, STEP_ATOMS):
        last = min(first + STEP_ATOMS, atoms)
        segments = _segments(text, bounds, cache, first, last)
        scores = _scores(segments, weights)
        kinds, tops = scores.argmax(1).tolist(), scores.max(1).tolist() if len(segments) else []
        for k, (i, j, _) in enumerate(segments):
            if tops[k] > 0:
                ending[j].append((i, tops[k], kinds[k]))
        for j in range(first + 1, last + 1):
            best[j] = best[j - 1]
            for i, score, kind in ending.pop(j, ()):
                if best[i] + score > best[j]:
                    best[j], back[j] = best[i] + score, (i, kind)
        if len(cache) > MAX_NAMES:
            cache.clear()
    out, j = [], len(bounds) - 1
    while j > 0:
        if j in back:
            i, kind = back[j]
            out.append((KINDS[kind], bounds[i], bounds[j]))
            j = i
        else:
            j -= 1
    return out[::-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _posteriors(count: int, segments: list, scores: np.ndarray) -> np.ndarray:
    """Probability of every segment and kind, by the forward and backward sums."""
    total = [_log_sum(s) for s in scores.tolist()]
    ending, starting = defaultdict(list), defaultdict(list)
    for k, (i, j, _) in enumerate(segments):
        ending[j].append((i, total[k]))
        starting[i].append((j, total[k]))
    forward, backward = [0.0] * (count + 1), [0.0] * (count + 1)
    for j in range(1, count + 1):
        forward[j] = _log_sum([forward[j - 1], *(forward[i] + s for i, s in ending.get(j, ()))])
    for i in range(count - 1, -1, -1):
        backward[i] = _log_sum([backward[i + 1], *(backward[j] + s for j, s in starting.get(i, ()))])
    outside = np.array([forward[i] + backward[j] - forward[count] for i, j, _ in segments])
    return np.exp(scores + outside[:, None])


def train(texts: list[str], epochs: int = EPOCHS) -> np.ndarray:
    """Weights of (feature, kind) by gradient steps on the likelihood of the labelled islands."""
    weights = np.zeros((_BUCKETS, len(KINDS)))
    squared = np.full_like(weights, 1e-6)
    cache: dict = {}
    examples = []
    for text in texts:
        gold = base_spans(text)
        variants = [(text, gold)]
        if len(gold) == 1 and gold[0][0] == "phone" and (cut := re.match(r"\+[0-9]+ +", text[gold[0][1] :])):
            _, start, end = gold[0]
            variants.append((text[:start] + text[start + cut.end() :], [("phone", start, end - cut.end())]))
        for own, spans in variants:
            bounds = _bounds(own)
            segments = _segments(own, bounds, cache)
            at = {(bounds[i], bounds[j]): k for k, (i, j, _) in enumerate(segments)}
            clear = all(a[2] <= b[1] or b[2] <= a[1] for a in spans for b in spans if a is not b)
            if segments and clear and all((s, e) in at for _, s, e in spans):
                truth = np.zeros((len(segments), len(KINDS)))
                for kind, s, e in spans:
                    truth[at[s, e], KINDS.index(kind)] = 1
                examples.append((len(bounds) - 1, segments, np.array([f for _, _, f in segments]), truth))
    for _ in range(epochs):
        for count, segments, features, truth in examples:
            gap = truth - _posteriors(count, segments, weights[features].sum(1))
            rows = np.flatnonzero(np.abs(gap).max(1) > 1e-4)
            if not len(rows):
                continue
            slope = np.zeros_like(weights)
            np.add.at(slope, features[rows], gap[rows, None, :])
            squared += slope**2
            weights += 0.5 * slope / np.sqrt(squared)
    return weights


def _strata(island: str) -> list[int]:
    """Numbers of the kinds that the base rules find in an island, or that of none."""
    return sorted({KINDS.index(kind) for kind, _, _ in base_spans(island)}) or [len(KINDS)]


def training_islands(docs: DataFrame, most: int = MAX_TRAINING, text_col: str = "text") -> list[str]:
    """``most`` different islands at most, in turn the next of every kind and of those without any.

    Inside a kind islands are ordered by a hash of their text.  Kinds with few islands leave
    their places to the others, so that all islands are taken where there are no more than ``most``.
    """

    def first(found):
        return set(sorted(found)[:most])

    def run(batches):
        # A task sends on what can still be among the first of a kind.
        kept: list[set] = [set() for _ in range(len(KINDS) + 1)]
        for batch in batches:
            own = {t[s:e] for t in batch.column(0).to_pylist() if t for s, e in islands(t) if e - s < MAX_LEARNED}
            for island in own:
                ranked = (xxhash.xxh64_intdigest(island.encode()), island)
                for stratum in _strata(island):
                    kept[stratum].add(ranked)
            kept = [first(found) if len(found) > 4 * most else found for found in kept]
        rows = [(island, stratum, hash_) for stratum, found in enumerate(kept) for hash_, island in first(found)]
        islands_, strata, hashes = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(islands_, pa.string()),
                pa.array(strata, pa.int32()),
                pa.array(hashes, pa.uint64()).cast(pa.decimal128(20, 0)),
            ],
            ["island", "stratum", "hash"],
        )

    found = docs.select(F.col(text_col).alias("text")).where(F.col("text").rlike("[0-9@]"))
    found = found.mapInArrow(run, "island string, stratum int, hash decimal(20,0)").dropDuplicates(["island", "stratum"])
    ranked = found.withColumn(
        "rank", F.row_number().over(Window.partitionBy("stratum").orderBy("hash", "island"))
    ).where(F.col("rank") <= most)
    chosen = ranked.groupBy("island", "hash").agg(F.min("rank").alias("rank")).orderBy("rank", "hash", "island")
    return [r["island"] for r in sorted(chosen.limit(most).collect(), key=lambda r: (r["hash"], r["island"]))]


def learn(docs: DataFrame, most: int = MAX_TRAINING, text_col: str = "text") -> np.ndarray:
    """Weights from a bounded number of different islands of the corpus, some of every kind."""
    return train(training_islands(docs, most, text_col))


_SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"


def find(
    docs: DataFrame,
    weights: np.ndarray,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """``doc_id, base, spans, masked`` of every document: base spans, all spans, masked text.

    Spans are in code points, by kind and start.  ``masked`` has the kind in brackets for each
    run of overlapping spans; it is null where nothing was found.  With ``carry`` the whole
    input row follows as ``row``.
    """
    order = {kind: n for n, kind in enumerate(KINDS)}
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def both(text, cache):
        base, added = [], []
        for start, end in islands(text):
            island = text[start:end]
            own = base_spans(island)
            more = [
                x for x in decode(island, weights, cache) if all(x[2] <= b[1] or b[2] <= x[1] for b in own)
            ]
            base += [(k, start + s, start + e) for k, s, e in own]
            added += [(k, start + s, start + e) for k, s, e in more]
        key = lambda x: (order[x[0]], x[1])
        return sorted(base, key=key), sorted(base + added, key=key)

    def mask(text, spans):
        out, at = [], 0
        for name, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
            if start >= at:
                out += [text[at:start], f"[{name.upper()}]"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def shown(spans):
        return [{"kind": k, "start": s, "end": e} for k, s, e in spans]

    def run(batches):
        cache: dict = {}
        for batch in batches:
            base, spans, masked = [], [], []
            for text in batch.column(1).to_pylist():
                own, every = both(text, cache) if text and _SIGN.search(text) else ([], [])
                base.append(shown(own))
                spans.append(shown(every))
                masked.append(mask(text, every) if every else None)
            made = {
                "base": pa.array(base, kind),
                "spans": pa.array(spans, kind),
                "masked": pa.array(masked, pa.string()),
            }
            yield words.result(batch, 0, batch.num_rows, made)

    own = words.picked(docs, id_col, text_col, carry)
    return own.mapInArrow(
        run,
        f"doc_id {words.kind_of(own, 'doc_id')}, base {_SPANS}, spans {_SPANS}, masked string{words.carried(own)}",
    )


def count_of(spans: str, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def listed(spans: str) -> F.Column:
    """Spans as ``kind:start:end`` texts, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
