"""Asking a corpus-wide table about every word window, in packed form.

Documents are dealt to parts of bounded size.  A part asks about its distinct 64-bit keys: the
sorted keys are cut into buckets by their leading bits and travel as byte planes of differences,
about six bytes a key instead of a row of thirty.  A bucket holds the same range of keys of all
parts, and its answers travel back to the parts.  Parts and buckets grow in number with the
corpus, not in size.
"""

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import shared

shared.ship(__name__)

#: Bytes of text in a part.
PART_BYTES = 8 << 20


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte: first the lowest byte of all, then the next."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def pack(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)


def cut(keys: np.ndarray, bits: int):
    """(bucket, start, end) of sorted keys, for buckets that have any."""
    edges = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    for bucket in np.flatnonzero(np.diff(edges)).tolist():
        yield bucket, int(edges[bucket]), int(edges[bucket + 1])


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted number in sorted ``keys``, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def groups(keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal sorted keys."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)


def parts(docs: DataFrame, part_bytes: int = PART_BYTES) -> tuple[DataFrame, int]:
    """``docs`` with a column ``part``, and the leading bits by which keys are cut into buckets.

    Rows are dealt by a hash of id and text, so that no source or id gathers in one part.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(math.ceil(size / part_bytes), 2 * docs.sparkSession.sparkContext.defaultParallelism)
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)).cast("int").alias("part")
    return docs.select(part, "*"), max(3, math.ceil(math.log2(count)))
