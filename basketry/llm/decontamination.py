"""Benchmark decontamination: runs of words that a document shares with a benchmark.

The windows of all benchmark items (ten words; all words of a shorter item) form a hash set
that is broadcast if its checked size allows, and joined by a shuffle otherwise.  Documents are
scanned window by window; a hit counts once its words are equal, not only their hashes.

Defined results: null and wordless texts have no words and no hits; items without words have no
windows; items of equal id are one item, a null id counts as ''; repeated documents are judged
alike; an empty benchmark hits nothing.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import shared
from basketry.llm import words

shared.ship(__name__)

WINDOW = 10
#: Most benchmark windows that are broadcast (about 100 bytes each); more go through a shuffle.
MAX_BROADCAST_WINDOWS = 250_000


def benchmark_windows(
    items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """Distinct ``size, words, item`` of all items, words lower-cased and joined by spaces."""

    def run(batches):
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), words.binary(batch.column(1))
            found = {"size": [], "words": [], "item": []}
            for name, text in zip(names, texts, strict=True):
                got = words.Words([text], words.NORMAL, lower=True)
                each = [got.word(i) for i in range(len(got))]
                size = min(window, len(each))
                for i in range(len(each) - size + 1 if size else 0):
                    found["size"].append(size)
                    found["words"].append(b" ".join(each[i : i + size]).decode())
                    found["item"].append(name)
            yield pa.RecordBatch.from_pydict(
                found, pa.schema([("size", pa.int32()), ("words", pa.string()), ("item", pa.string())])
            )

    picked = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text")
    )
    return picked.mapInArrow(run, "size int, words string, item string").distinct()


class WindowSet:
    """Hashes of benchmark windows by their size, and the items of each window."""

    def __init__(self, rows):
        items = defaultdict(list)
        for size, text, item in rows:
            items[size, text.encode()].append(item)
        self.sizes = {}
        for size in {s for s, _ in items}:
            texts = [t for s, t in items if s == size]
            got = words.Words(texts)
            keys = words.windows(got.hashes(), size)[got.first[:-1]]
            order = np.argsort(keys)
            present = np.zeros(1 << 20, bool)
            present[keys >> np.uint64(44)] = True
            by_text = {t: items[size, t] for t in texts}
            self.sizes[size] = (keys[order], present, by_text)

    def hits(self, got: words.Words) -> list[tuple[int, int, list[str]]]:
        """(first word, number of words, items) of each occurrence in a batch of texts."""
        found = []
        hashes, left = got.hashes(), got.left()
        for size, (keys, present, by_text) in self.sizes.items():
            probes = words.windows(hashes, size)
            at = np.flatnonzero(present[probes >> np.uint64(44)] & (left >= size))
            place = np.minimum(np.searchsorted(keys, probes[at]), len(keys) - 1)
            for i in at[keys[place] == probes[at]].tolist():
                text = b" ".join([got.word(j) for j in range(i, i + size)])
                if text in by_text:
                    found.append((i, size, by_text[text]))
        return found


_FOUND = "n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<string>, clean string"


def _without(got: words.Words, texts: list, marked: np.ndarray, i: int) -> str | None:
    """Text ``i`` without its marked words and what stands between two of them."""
    if texts[i] is None:
        return None
    keep, begin, shift = [], 0, got.offsets[i]
    for run in words.runs(marked[got.first[i] : got.first[i + 1]], np.array([0, got.counts[i]]))[0]:
        first, last = got.first[i] + run["start"], got.first[i] + run["end"] - 1
        keep.append(texts[i][begin : got.starts[first] - shift])
        begin = got.ends[last] - shift
    return b"".join([*keep, texts[i][begin:]]).decode()


def _by_broadcast(docs: DataFrame, rows: list) -> DataFrame:
    sent = shared.send(docs.sparkSession, WindowSet(rows))

    def run(batches):
        windows = shared.received(sent)
        for batch in batches:
            for start, end in words.text_slices(texts := words.binary(batch.column(1))):
                some = texts[start:end]
                got = words.Words(some, words.NORMAL, lower=True)
                marked = np.zeros(len(got), bool)
                items = defaultdict(set)
                for i, size, names in windows.hits(got):
                    marked[i : i + size] = True
                    items[int(got.text_of[i])].update(names)
                clean = [_without(got, some, marked, i) if i in items else None for i in range(len(some))]
                named = [sorted(items.get(i, ())) for i in range(len(some))]
                made = {
                    "n_words": pa.array(got.counts, pa.int64()),
                    "spans": pa.array(words.runs(marked, got.first), words.spans_type()),
                    "items": pa.array(named, pa.list_(pa.string())),
                    "clean": pa.array(clean, pa.string()),
                }
                yield words.result(batch, start, end, made)

    return docs.mapInArrow(run, f"doc_id {words.kind_of(docs, 'doc_id')}, {_FOUND}{words.carried(docs)}")


def _by_shuffle(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """The same for a benchmark of any size: document windows are joined with its windows.

    Matches come back as one row per document and window, so a document's row is as large as
    its own matches.  Equal documents are matched once.
    """
    sizes = [r[0] for r in windows.select("size").distinct().collect()]  # at most ``window`` sizes
    docs = docs.withColumn("key", F.sha2(F.coalesce("text", F.lit("")), 256))

    def probe(batches):
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), words.binary(batch.column(1))
            for key, text in zip(keys, texts, strict=True):
                got = words.Words([text], words.NORMAL, lower=True)
                each = [got.word(i).decode() for i in range(len(got))]
                for size in sizes:
                    n = len(each) - size + 1
                    if n > 0:
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([key] * n),
                                pa.array(range(n), pa.int64()),
                                pa.array([size] * n, pa.int32()),
                                pa.array([" ".join(each[i : i + size]) for i in range(n)]),
                            ],
                            ["key", "at", "size", "words"],
                        )

    probes = docs.select("key", "text").dropDuplicates(["key"]).mapInArrow(
        probe, "key string, at bigint, size int, words string"
    )
    matched = (
        probes.join(windows, ["size", "words"])
        .groupBy("key")
        .agg(
            F.collect_set(F.struct("at", "size")).alias("matches"),
            F.sort_array(F.collect_set("item")).alias("items"),
        )
    )

    def finish(batches):
        for batch in batches:
            texts, matches = words.binary(batch.column(1)), batch.column(2).to_pylist()
            counts, spans, clean = [], [], []
            for i, text in enumerate(texts):
                got = words.Words([text], words.NORMAL, lower=True)
                marked = np.zeros(len(got), bool)
                for m in matches[i] or ():
                    marked[m["at"] : m["at"] + m["size"]] = True
                counts.append(len(got))
                spans += words.runs(marked, got.first)
                clean.append(_without(got, [text], marked, 0) if matches[i] else None)
            made = {
                "n_words": pa.array(counts, pa.int64()),
                "spans": pa.array(spans, words.spans_type()),
                "items": batch.column(3).cast(pa.list_(pa.string())),
                "clean": pa.array(clean, pa.string()),
            }
            yield words.result(batch, 0, batch.num_rows, made)

    both = docs.join(matched, "key", "left").select(
        "doc_id",
        "text",
        "matches",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        *(["row"] if "row" in docs.columns else []),
    )
    return both.mapInArrow(finish, f"doc_id {words.kind_of(docs, 'doc_id')}, {_FOUND}{words.carried(docs)}")


def scan(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    max_broadcast: int = MAX_BROADCAST_WINDOWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """``doc_id, n_words, spans, items, clean`` of every document.

    ``spans`` are the runs of hit words, end exclusive; ``items`` the sorted ids of items with
    an occurring window; ``clean`` the text without its hit words, null if nothing was hit.  With ``carry`` the whole input row
    follows as ``row``.
    """
    docs = words.picked(docs, id_col, text_col, carry)
    windows = shared.stage(benchmark_windows(items, window), "benchmark-windows")
    if windows.count() <= max_broadcast:
        return _by_broadcast(docs, [tuple(r) for r in windows.collect()])
    return _by_shuffle(docs, windows)


def n_hit() -> F.Column:
    """Number of hit words of a scanned document."""
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
