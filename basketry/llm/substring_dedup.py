"""Substring deduplication with fixed-block anchors.

Two documents that share a window of 13 words share in it a block of 7 words that starts at a
multiple of 7 in the first of them.  So the blocks of all documents are the index, and every
rolling window of 7 words probes it.  Around each hit the windows of 13 words are asked for the
smallest document they start in; neighbouring windows that start in a smaller document make a
maximal exact repeat, whose words are removed.

Defined results: null and wordless texts have no words and nothing to remove; a document is
never compared with itself or with rows of equal id; a null id counts as larger than all others
and is nobody's source; repeated rows are judged alike; windows are judged on the input.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import shared
from basketry.llm import packed, words

shared.ship(__name__)

WINDOW = 13
_LAST = np.iinfo(np.int64).max
#: Blocks only say where to look, so 56 bits of their hash are enough.
_BLOCK_BITS = np.uint64(0xFFFFFFFFFFFFFF00)
_ASK = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("facts", pa.binary())])
_ASK_DDL = "part int, bucket int, keys binary, facts binary"


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class _Part:
    """Words and ids of one part's documents."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.texts = words.binary(table["text"])
        ids = table["doc_id"].to_pylist()
        self.ids = np.array([_LAST if i is None else i for i in ids], np.int64)
        self.id_column = table["doc_id"].combine_chunks()
        self.number = table["part"][0].as_py()
        self.words = words.Words(self.texts)
        self.hashes = self.words.hashes()
        self.left = self.words.left()

    def windows(self, size: int) -> np.ndarray:
        return words.windows(self.hashes, size)


def _blocks(part: _Part, block: int) -> np.ndarray:
    return part.windows(block) & _BLOCK_BITS


def _block(window: int) -> int:
    """Longest block of which any window of ``window`` words holds an aligned one."""
    return (window + 1) // 2


def _probes(part: _Part, block: int, bits: int) -> pa.Table:
    """All distinct rolling windows: is one an index block, and is it in several documents?"""
    at = np.flatnonzero(part.left >= block)
    keys = _blocks(part, block)[at]
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    starts = packed.groups(keys)
    if not len(starts):
        return _rows([], _ASK)
    indexed = np.logical_or.reduceat(part.words.place()[at] % block == 0, starts)
    owners = part.ids[part.words.text_of[at]]
    several = np.minimum.reduceat(owners, starts) != np.maximum.reduceat(owners, starts)
    facts = indexed.astype(np.uint8) | several.astype(np.uint8) << 1
    keys = keys[starts]
    return _rows(
        [(part.number, b, packed.pack(keys[s:e]), facts[s:e].tobytes()) for b, s, e in packed.cut(keys, bits)],
        _ASK,
    )


def _match(table: pa.Table) -> pa.Table:
    """Keys of a bucket that are an index block somewhere and lie in several documents."""
    keys = [packed.unpack(x) for x in table["keys"].to_pylist()]
    facts = np.concatenate([np.frombuffer(x, np.uint8) for x in table["facts"].to_pylist()])
    source = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    starts = packed.groups(every[order])
    seen = np.bitwise_or.reduceat(facts[order], starts)
    sizes = np.diff(np.append(starts, len(every)))
    hit = (seen & 1 > 0) & ((sizes > 1) | (seen & 2 > 0))
    chosen = order[np.repeat(hit, sizes)]
    numbers, buckets = table["part"].to_pylist(), table["bucket"].to_pylist()
    out = []
    for i in np.unique(source[chosen]).tolist():
        out.append((numbers[i], buckets[i], packed.pack(np.sort(every[chosen[source[chosen] == i]])), None))
    return _rows(out, _ASK)


def _around_hits(part: _Part, hits: np.ndarray, window: int) -> np.ndarray:
    """Starts of the whole windows that hold a hit block."""
    block = _block(window)
    _, hit = packed.find(hits, _blocks(part, block))
    hit &= part.left >= block
    counted = np.concatenate([[0], np.cumsum(hit)])
    last = np.minimum(np.arange(len(hit)) + window - block + 1, len(hit))
    return np.flatnonzero((part.left >= window) & (counted[last] > counted[np.arange(len(hit))]))


def _ask_least(part: _Part, hits: np.ndarray, window: int, bits: int) -> pa.Table:
    """Distinct windows around hits with the smallest document of the part."""
    at = _around_hits(part, hits, window)
    keys, owners = part.windows(window)[at], part.ids[part.words.text_of[at]]
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    starts = packed.groups(keys)
    least, most = owners[starts], np.maximum.reduceat(owners, starts) if len(starts) else owners
    facts = np.concatenate([least.view(np.uint8).reshape(-1, 8), (least != most).view(np.uint8)[:, None]], 1)
    keys = keys[starts]
    return _rows(
        [(part.number, b, packed.pack(keys[s:e]), facts[s:e].T.tobytes()) for b, s, e in packed.cut(keys, bits)],
        _ASK,
    )


def _least(table: pa.Table) -> pa.Table:
    """For each part, the keys that start in a smaller document than some of its own."""
    keys = [packed.unpack(x) for x in table["keys"].to_pylist()]
    facts = [np.frombuffer(x, np.uint8).reshape(9, -1).T for x in table["facts"].to_pylist()]
    own = np.concatenate([np.ascontiguousarray(f[:, :8]).view(np.int64).ravel() for f in facts])
    several = np.concatenate([f[:, 8] for f in facts]) > 0
    source = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    starts = packed.groups(every[order])
    least = np.empty(len(every), np.int64)
    least[order] = np.repeat(
        np.minimum.reduceat(own[order], starts), np.diff(np.append(starts, len(every)))
    )
    told = (least < own) | several
    numbers, out = table["part"].to_pylist(), []
    for i in np.unique(source[told]).tolist():
        chosen = np.flatnonzero(told & (source == i))
        out.append((numbers[i], table["bucket"][i].as_py(), packed.pack(every[chosen]), packed.planes(least[chosen])))
    return _rows(out, _ASK)


def _finish(part: _Part, keys: np.ndarray, least: np.ndarray, window: int) -> pa.Table:
    got = part.words
    at, found = packed.find(keys, part.windows(window))
    found &= part.left >= window
    starts = np.flatnonzero(found)
    starts = starts[least[at[starts]] < part.ids[got.text_of[starts]]]
    steps = np.zeros(len(got) + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    removed = np.cumsum(steps[:-1]) > 0
    counts = np.add.reduceat(np.append(removed, False).astype(np.int64), got.first[:-1]) if len(part.texts) else []
    counts = np.where(got.counts > 0, counts, 0)
    kept = []
    for i, text in enumerate(part.texts):
        own = (text or b"").split()
        if counts[i]:
            gone = removed[got.first[i] : got.first[i + 1]]
            own = [own[j] for j in np.flatnonzero(~gone).tolist()]
        kept.append(b" ".join(own))
    return pa.table(
        {
            "doc_id": part.id_column,
            "n_words": pa.array(got.counts, pa.int64()),
            "n_removed": pa.array(counts, pa.int64()),
            "repeats": pa.array(words.runs(removed, got.first), words.spans_type()),
            "kept": pa.array(kept, pa.binary()).cast(pa.string()),
        }
    )


def _sorted_answers(table: pa.Table) -> tuple[np.ndarray, list]:
    """Keys of all answers to a part, in order, and their facts."""
    rows = sorted(zip(table["bucket"].to_pylist(), table["keys"].to_pylist(), table["facts"].to_pylist(), strict=True))
    keys = [packed.unpack(k) for _, k, _ in rows]
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64), [f for _, _, f in rows]


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_removed, repeats, kept`` of every document (integer ids).

    ``repeats`` are the runs of removed words, end exclusive; ``kept`` the other words joined by
    a space.
    """
    block = _block(window)
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    dealt, bits = packed.parts(docs)

    def probes(table):
        return _probes(_Part(table), block, bits)

    def ask(table, answers):
        return _ask_least(_Part(table), _sorted_answers(answers)[0], window, bits)

    def finish(table, answers):
        keys, facts = _sorted_answers(answers)
        least = [packed.from_planes(f, np.int64) for f in facts]
        return _finish(_Part(table), keys, np.concatenate(least) if least else np.zeros(0, np.int64), window)

    def by_part(df):
        return df.groupBy("part")

    hits = by_part(dealt).applyInArrow(probes, _ASK_DDL).groupBy("bucket").applyInArrow(_match, _ASK_DDL)
    asked = by_part(dealt).cogroup(by_part(hits)).applyInArrow(ask, _ASK_DDL)
    least = asked.groupBy("bucket").applyInArrow(_least, _ASK_DDL)
    return by_part(dealt).cogroup(by_part(least)).applyInArrow(
        finish,
        f"doc_id {kind}, n_words bigint, n_removed bigint, "
        "repeats array<struct<start: bigint, end: bigint>>, kept string",
    )
