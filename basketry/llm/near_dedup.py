"""Near-duplicate documents by ProbMinHash.

A text is the weighted set of its five-word shingles, weights being counts.  Every shingle's
arrivals form a Poisson process of its weight; each arrival falls on a random register, a
register keeps the earliest shingle, and a text stops when no later arrival can win.  Two texts
agree in a register with the probability Jaccard of their sets.  Registers are banded, texts that
share a band are candidates, and candidates are verified: their sets of shingles must have a
Jaccard similarity of 0.8 or more.  Where counts differ the probability Jaccard may be far below
that, so a text that repeats shingles also has the bands of the same registers with all weights 1,
which agree with the Jaccard similarity; a text that repeats none has the same bands either way.

Equal texts are collapsed first.  The candidates of the smallest text of a band bucket form its
group; groups are cut into blocks bounded in texts and bytes, so that no task holds a hot one.  Inside a
block all pairs that aren't connected yet are compared; texts of a cut group that aren't like
its centre are compared with the other blocks in a second step.  Classes are the connected
components of the links.

Defined results: a null text counts as empty; a text without words is a class of its own, equal
ones together; a text of fewer than five words is one shingle; rows of equal id are one
document, of the smallest text digest; rows with a null id are left out of the classes.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import shared
from basketry.llm import words

shared.ship(__name__)

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 4
#: Texts that a task compares with each other.
BLOCK = 256
#: Bytes of their shingle hashes, about; a larger text is still compared whole.
BLOCK_BYTES = 4 << 20
#: Bytes of text that are worked on together: signing needs some 30 times as much.
_SLICE = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: list[bytes | None], size: int = SHINGLE) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingle hashes of each text, sorted, and their counts."""
    got = words.Words(texts)
    hashes = got.hashes()
    full = words.windows(hashes, size)
    out = []
    for first, count in zip(got.first[:-1].tolist(), got.counts.tolist(), strict=True):
        if count >= size:
            own = full[first : first + count - size + 1]
        elif count:
            own = words.windows(hashes[first : first + count], count)[:1]
        else:
            own = full[:0]
        out.append(np.unique(own, return_counts=True))
    return out


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """The winning shingle of every register, one row per (non-empty) set."""
    sizes = [len(k) for k, _ in sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    keys = np.concatenate([k for k, _ in sets])
    weights = np.concatenate([w for _, w in sets]).astype(float)
    time = np.zeros(len(keys))
    best = np.full(len(sets) * registers, np.inf)
    winner = np.zeros(len(best), np.uint64)
    active = np.arange(len(keys))
    arrival = np.zeros(1, np.uint64)
    while len(active):
        arrival += _STEP
        draw = words.mix(keys[active] + arrival)
        uniform = ((draw >> np.uint64(11)).astype(float) + 1) * 2.0**-53
        time[active] -= np.log(uniform) / weights[active]
        register = (words.mix(draw ^ _STEP) % np.uint64(registers)).astype(np.int64)
        at = owner[active] * registers + register
        earlier = np.flatnonzero(time[active] < best[at])
        at, now = at[earlier], time[active[earlier]]
        np.minimum.at(best, at, now)
        won = now == best[at]
        winner[at[won]] = keys[active[earlier[won]]]
        latest = best.reshape(len(sets), registers).max(1)
        active = active[time[active] < latest[owner[active]]]
    return winner.reshape(len(sets), registers)


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One number per band, different bands having different numbers."""
    parts = signature.reshape(len(signature), bands, rows)
    out = np.broadcast_to(words.mix(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for r in range(rows):
        out = words.mix(out * _STEP + parts[:, :, r])
    return out.view(np.int64)


def candidate_keys(sets: list[tuple[np.ndarray, np.ndarray]], bands: int, rows: int) -> list[list[int]]:
    """Band keys of every (non-empty) set: by its counts, and by weights of 1 where counts differ from it."""
    out = band_keys(signatures(sets, bands * rows), bands, rows).tolist()
    counted = [i for i, (_, w) in enumerate(sets) if w.max() > 1]
    if counted:
        plain = [(sets[i][0], np.ones(len(sets[i][0]))) for i in counted]
        for i, own in zip(counted, band_keys(signatures(plain, bands * rows), bands, rows).tolist(), strict=True):
            out[i] = list(dict.fromkeys(out[i] + own))
    return out


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


class _Sets:
    """Forest of the sets that a task compares; sets are put together once linked."""

    def __init__(self, table: pa.Table, first=None):
        """In the table's order, or ``first`` and then by id."""
        ids, keys = table.column("id").to_pylist(), list(table.column("keys"))
        order = range(len(ids)) if first is None else sorted(range(len(ids)), key=lambda i: (ids[i] != first, ids[i]))
        self.ids = [ids[i] for i in order]
        self.sets = [np.frombuffer(keys[i].as_buffer(), np.uint64) for i in order]
        self.parent = list(range(len(self.ids)))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def join(self, i: int, j: int) -> None:
        self.parent[max(self.root(i), self.root(j))] = min(self.root(i), self.root(j))

    def alike(self, i: int, j: int, least: float) -> bool:
        a, b = self.sets[i], self.sets[j]
        if min(len(a), len(b)) < least * max(len(a), len(b)):
            return False
        return similarity(a, b) >= least


def _pack(docs: DataFrame) -> DataFrame:
    """``id, keys, size`` of every text, the shingle hashes as bytes and how many bytes they are."""

    def run(batches):
        for batch in batches:
            for start, end in words.column_slices(batch.column(1), _SLICE):
                sets = shingles(words.binary(batch.column(1).slice(start, end - start)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array([k.tobytes() for k, _ in sets], pa.binary()),
                        pa.array([k.nbytes for k, _ in sets], pa.int64()),
                    ],
                    ["id", "keys", "size"],
                )

    return docs.mapInArrow(run, f"id {words.kind_of(docs, 'doc_id')}, keys binary, size bigint")


def sign(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, digest, bands`` of ``doc_id, text``; no bands where a text has no words."""

    def run(batches):
        for batch in batches:
            for start, end in words.column_slices(batch.column(1), _SLICE):
                some = words.binary(batch.column(1).slice(start, end - start))
                sets = shingles(some)
                filled = [i for i, (k, _) in enumerate(sets) if len(k)]
                found: list = [[]] * len(some)
                if filled:
                    keys = candidate_keys([sets[i] for i in filled], bands, rows)
                    for i, own in zip(filled, keys, strict=True):
                        found[i] = own
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array([hashlib.md5(t or b"").digest() for t in some], pa.binary()),
                        pa.array(found, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "digest", "bands"],
                )

    return docs.mapInArrow(
        run, f"doc_id {words.kind_of(docs, 'doc_id')}, digest binary, bands array<bigint>"
    )


def _groups(texts: DataFrame) -> DataFrame:
    """``centre, id``: each text with the smallest text of every band bucket it is in."""
    buckets = texts.select("id", F.explode("bands").alias("key"))
    centres = (
        buckets.groupBy("key")
        .agg(F.min("id").alias("centre"), F.max("id").alias("last"))
        .where("centre < last")
        .select("key", "centre")
    )
    return buckets.join(centres, "key").where("id <> centre").select("centre", "id").distinct()


def links(
    groups: DataFrame,
    docs: DataFrame,
    own: DataFrame,
    least: float = SIMILARITY,
    block: int = BLOCK,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``a, b``: a forest that connects the texts whose verified links connect them.

    ``own`` has the ``digest`` of the text that each ``doc_id`` stands for.
    """
    kind = words.kind_of(groups, "id")
    needed = groups.select(F.explode(F.array("centre", "id")).alias("doc_id")).distinct().join(own, "doc_id")
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    judged = docs.withColumn("digest", digest).join(needed, ["doc_id", "digest"], "left_semi")
    sets = shared.stage(_pack(judged.select("doc_id", "text")), "sets")

    def dealt(texts: DataFrame, number: str) -> DataFrame:
        """``centre`` and the ``number`` of blocks that its texts (``centre, id``) need."""
        held = sets.groupBy("id").agg(F.sum("size").alias("size"))
        parts = F.greatest(F.count("*") / block, F.sum("size") / block_bytes)
        return texts.join(held, "id").groupBy("centre").agg(F.ceil(parts).cast("int").alias(number))

    sets_of = sets.select("id", "keys")
    sizes = dealt(groups, "blocks")
    members = groups.join(sizes, "centre").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )
    centres = sizes.select(
        "centre",
        F.col("centre").alias("id"),
        "blocks",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    placed = shared.stage(
        members.select("centre", "id", "blocks", "block").unionByName(
            centres.select("centre", "id", "blocks", "block")
        ),
        "blocks",
    )

    def inside(key, table):
        """Compare a block's texts, the centre first; say who isn't connected to it."""
        centre = key[0].as_py()
        own = _Sets(table, centre)
        found = []
        for i in range(1, len(own.ids)):
            if own.alike(0, i, least):
                own.join(0, i)
                found.append((own.ids[0], own.ids[i]))
        rest = [i for i in range(1, len(own.ids)) if own.root(i)]
        for i in rest:
            for j in range(1, len(own.ids)):
                if own.root(i) != own.root(j) and own.alike(i, j, least):
                    own.join(i, j)
                    found.append((own.ids[i], own.ids[j]))
        cut = table["blocks"][0].as_py() > 1
        left = [own.ids[i] for i in rest if own.root(i)] if cut else []
        return pa.table(
            {
                "centre": pa.array([centre] * (len(found) + len(left)), table["centre"].type),
                "a": pa.array([a for a, _ in found] + left, table["id"].type),
                "b": pa.array([b for _, b in found] + [None] * len(left), table["id"].type),
            }
        )

    filled = placed.join(sets_of, "id").select("centre", "id", "blocks", "block", "keys")
    first = shared.stage(
        filled.groupBy("centre", "block").applyInArrow(inside, f"centre {kind}, a {kind}, b {kind}"),
        "block-links",
    )
    left = first.where("b IS NULL").select("centre", F.col("a").alias("id"))
    found = first.where("b IS NOT NULL").select("a", "b")
    if left.isEmpty():
        return found

    # What isn't like the centre of a cut group meets every block of it.
    chunks = dealt(left, "chunks")
    sides = ["centre", "id", "block", "chunk", "single"]
    single = (
        left.join(chunks, "centre")
        .join(placed.where("id = centre").select("centre", "blocks").distinct(), "centre")
        .withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), F.col("chunks")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("single", F.lit(True))
        .select(sides)
    )
    others = (
        placed.where("id <> centre")
        .join(chunks, "centre")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("single", F.lit(False))
        .select(sides)
    )

    def across(table):
        own = _Sets(table)
        single = table["single"].to_pylist()
        found = []
        seen: dict = {}
        for i, name in enumerate(own.ids):
            own.join(seen.setdefault(name, i), i)
        for i in range(len(single)):
            for j in range(len(single)):
                if single[i] and not single[j] and own.root(i) != own.root(j) and own.alike(i, j, least):
                    own.join(i, j)
                    found.append((own.ids[i], own.ids[j]))
        kind = table["id"].type
        return pa.table({"a": pa.array([a for a, _ in found], kind), "b": pa.array([b for _, b in found], kind)})

    met = single.unionByName(others).join(sets_of, "id").groupBy("centre", "block", "chunk")
    return shared.stage(found.unionByName(met.applyInArrow(across, f"a {kind}, b {kind}")), "all-links")


def components(edges: DataFrame) -> DataFrame:
    """``id, class``: the smallest text of each connected component, for all texts with an edge.

    Large-star and small-star steps in turn, each a pair of joins by one end of the edges.
    """

    def star(both: DataFrame) -> DataFrame:
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.join(least, "a")

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    down = shared.stage(down.distinct(), "edges")
    before, now = None, state(down)
    while now != before:
        both = down.unionByName(down.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = star(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = star(large)
        linked = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            small.select("a", F.col("m").alias("b"))
        )
        down = shared.stage(linked.where("a <> b").distinct(), "edges")
        before, now = now, state(down)
    members = down.select(F.col("a").alias("id"), F.col("b").alias("class"))
    return members.unionByName(down.select(F.col("b").alias("id"), F.col("b").alias("class")).distinct())


def classes(
    docs: DataFrame,
    least: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, text_id, class_id`` of every document.

    ``text_id`` is the smallest id among equal texts, ``class_id`` the smallest id of the
    near-duplicate class; the document that has it as its own id stands for the class.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(
        F.col("doc_id").isNotNull()
    )
    signed = shared.stage(sign(docs, bands, rows), "signatures")
    own = signed.groupBy("doc_id").agg(F.min("digest").alias("digest"))
    # Other texts of an id are no nodes: they would connect what only shares the id.
    first = signed.join(own, ["doc_id", "digest"], "left_semi")
    texts = first.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands"))
    groups = shared.stage(_groups(texts), "groups")
    found = components(links(groups, docs, own, least, block, block_bytes))
    named = texts.select("digest", "id").join(found, "id", "left").select(
        "digest", F.col("id").alias("text_id"), F.coalesce("class", "id").alias("class_id")
    )
    return own.join(named, "digest").select("doc_id", "text_id", "class_id")
