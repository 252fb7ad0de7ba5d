"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Texts are joined with a line feed, which no kind of word contains, so a word never spans two
texts.  A word's hash is a polynomial over its bytes; a window's hash one over its words.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import shared

shared.ship(__name__)

#: Bytes of text that are worked on together.
BATCH_BYTES = 4 << 20
_CHUNK = 1 << 20
_BYTE_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD_STEP = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(step: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, step)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BYTE_STEP)
#: [^ \t-\r]+
PLAIN = np.ones(256, bool)
PLAIN[[32, *range(9, 14)]] = False
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of text whose A-Z are lower-cased
NORMAL = np.zeros(256, bool)
NORMAL[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """``starts`` and ``ends`` of all words, ``first`` the first word of every text (and the end)."""

    def __init__(self, texts: list[bytes | None], kind: np.ndarray = PLAIN, lower: bool = False):
        texts = [t or b"" for t in texts]
        self.joined = b"\n".join(texts)
        data = np.frombuffer(self.joined, np.uint8)
        self.data = LOWER[data] if lower else data
        edges = np.diff(kind[self.data].view(np.int8), prepend=np.int8(0), append=np.int8(0))
        self.starts = np.flatnonzero(edges == 1)
        self.ends = np.flatnonzero(edges == -1)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offsets = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self.text_of = np.repeat(np.arange(len(texts)), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def place(self) -> np.ndarray:
        """Position of every word in its text."""
        return np.arange(len(self)) - np.repeat(self.first[:-1], self.counts)

    def left(self) -> np.ndarray:
        """Words from every word to the end of its text, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self), np.uint64)
        start = 0
        while start < len(self):
            at = self.starts[start]
            stop = max(start + 1, int(np.searchsorted(self.ends, at + _CHUNK)))
            size = int(self.ends[stop - 1] - at)
            step = _powers(_BYTE_STEP, size + 1)
            summed = np.zeros(size + 1, np.uint64)
            np.cumsum(_VALUES[self.data[at : at + size]] * step[:-1], out=summed[1:])
            begin, end = self.starts[start:stop] - at, self.ends[start:stop] - at
            back = _powers(_INVERSE, size + 1)
            out[start:stop] = (summed[end] - summed[begin]) * back[begin]
            start = stop
        return mix(out + (self.ends - self.starts).astype(np.uint64))


#: The number that undoes a multiplication by _BYTE_STEP modulo 2^64.
_INVERSE = np.uint64(pow(int(_BYTE_STEP), -1, 1 << 64))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on; of no meaning where the text ends before."""
    count = len(hashes)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    out = padded[:count].copy()
    for j in range(1, size):
        out *= _WORD_STEP
        out += padded[j : j + count]
    return mix(out)


def text_slices(texts: list, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of about ``limit`` bytes; a longer text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def column_slices(column, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """As ``text_slices`` for an Arrow text column, none of which need be Python objects for it."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = int(ends[start - 1]) if start else 0
        stop = min(int(np.searchsorted(ends, before + limit)) + 1, len(sizes))
        yield start, stop
        start = stop


def binary(column) -> list[bytes | None]:
    """The UTF-8 bytes of an Arrow text column."""
    return column.cast(pa.binary()).to_pylist()


def kind_of(df: DataFrame, column: str) -> str:
    """A column's type as DDL."""
    return df.schema[column].dataType.simpleString()


def picked(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """``doc_id, text``, and with ``carry`` the whole row as a struct, whatever its columns are."""
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *row)


def carried(df: DataFrame) -> str:
    """DDL of the carried row, to append to a result's."""
    return f", row {kind_of(df, 'row')}" if "row" in df.columns else ""


def result(batch: pa.RecordBatch, start: int, end: int, columns: dict) -> pa.RecordBatch:
    """Rows ``start`` to ``end`` of a batch of picked rows with the columns made for them."""
    own = batch.slice(start, end - start)
    made = {"doc_id": own.column(0), **columns}
    if "row" in own.schema.names:
        made["row"] = own.column(own.schema.get_field_index("row"))
    return pa.RecordBatch.from_arrays(list(made.values()), list(made))


def spans_type() -> pa.DataType:
    return pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def runs(marked: np.ndarray, first: np.ndarray) -> list[list[dict]]:
    """Runs of marked words of every text, as word positions in it."""
    out = []
    where = np.flatnonzero(marked)
    cuts = np.searchsorted(where, first)
    for i in range(len(first) - 1):
        own = where[cuts[i] : cuts[i + 1]] - first[i]
        if not len(own):
            out.append([])
            continue
        breaks = np.flatnonzero(np.diff(own) > 1)
        begin = own[np.concatenate([[0], breaks + 1])]
        end = own[np.concatenate([breaks, [len(own) - 1]])] + 1
        out.append([{"start": s, "end": e} for s, e in zip(begin.tolist(), end.tolist(), strict=True)])
    return out
