"""Near-duplicate vectors of equal label, by cross-polytope hashing.

A vector is turned by three rounds of random signs and a fast Hadamard transform; the axis it then
lies next to, with its sign, is a hash.  The hashes of some turns together name a bucket.  Each
vector is put in its own bucket of every table and probes the buckets whose axes come next in
nearness.  How many hashes a bucket takes grows with the logarithm of the vectors of a label, so
buckets stay of one size.

Buckets hold 128 signs of another turn instead of vectors; near vectors differ in few of them.  Such
pairs, as a forest over each bucket, are the candidates.  A candidate component is then compared
whole, by cosine in double precision, each of its vectors being sent once.  Buckets and components of
more than a block are cut into blocks, and two blocks meet in one task: no task holds a hot one, and
no pairs are written, only counts and a forest.  Equal vectors are collapsed before the comparison.

Defined results: vectors that are null, empty or zero, that hold nulls or numbers that aren't finite,
and those with a null label or null id link with nothing; vectors of unlike length don't either;
equal vectors link; repeated rows count each, and rows of equal id count as different vectors; a row
with a null id has no component and is kept; other columns are ignored.
"""

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from basketry import shared
from basketry.llm import near_dedup, words

shared.ship(__name__)
shared.ship(near_dedup.__name__)

SIMILARITY = 0.93
#: Vectors of a bucket or component that meet in a task are at most two blocks.
BLOCK = 512
#: Vectors that share an own bucket, about; rows of a task of small buckets.
BUCKET = 512
_TASK_ROWS = 200_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SIGNS = 128
#: Of 128 signs, two vectors of cosine 0.93 differ in 15 with a standard deviation below 4.
MAX_DIFFERENT = 31


def tables_and_probes(hashes: int) -> tuple[int, int]:
    """Tables, and probes beside the own bucket, for buckets of so many hashes."""
    return 1 + hashes, 2**hashes


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of rows whose length is a power of two, keeping their norm."""
    rows, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(rows, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(rows, width)
        step *= 2
    return x / math.sqrt(width)


def turn(x: np.ndarray, number: int) -> np.ndarray:
    """The pseudo-random turn of that number: three rounds of signs and transform."""
    signs = np.random.default_rng([number, x.shape[1]]).choice(np.array([-1.0, 1.0], np.float32), (3, x.shape[1]))
    for own in signs:
        x = hadamard(x * own)
    return x


def padded(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors with zeros up to a power of two, in single precision."""
    unit = vectors / np.abs(vectors).max(1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    width = 1 << max(1, (vectors.shape[1] - 1).bit_length())
    out = np.zeros((len(unit), width), np.float32)
    out[:, : unit.shape[1]] = unit
    return out


def signs(x: np.ndarray) -> np.ndarray:
    """128 signs of each row, as two numbers."""
    turns = -(-_SIGNS // x.shape[1])
    bits = np.concatenate([turn(x, 1_000_000 + t) for t in range(turns)], 1)[:, :_SIGNS] > 0
    return np.packbits(bits, axis=1).view(np.int64)


def bucket_keys(x: np.ndarray, space: np.ndarray, hashes: int) -> np.ndarray:
    """For every row and table the key of its own bucket, then those of its probes."""
    tables, probes = tables_and_probes(hashes)
    depth = max(2, min(probes + 1, int(81 ** (1 / hashes) + 1e-9)), math.ceil((probes + 1) ** (1 / hashes)))
    depth = min(depth, x.shape[1])
    combos = np.array(list(itertools.product(range(depth), repeat=hashes)))
    out = np.empty((len(x), tables, min(probes + 1, len(combos))), np.uint64)
    rows = np.arange(len(x))[:, None]
    for table in range(tables):
        loss = np.zeros((len(x), len(combos)), np.float32)
        names = words.mix(space.view(np.uint64) + np.uint64(table + 1))
        keys = np.broadcast_to(names[:, None], loss.shape).copy()
        for h in range(hashes):
            y = turn(x, table * hashes + h)
            size = np.abs(y)
            near = np.argsort(-size, axis=1, kind="stable")[:, :depth]
            sizes = size[rows, near]
            axis = near + x.shape[1] * (y[rows, near] < 0)
            loss += ((sizes[:, :1] - sizes) ** 2)[:, combos[:, h]]
            keys = words.mix(keys * _STEP + axis.astype(np.uint64)[:, combos[:, h]])
        best = np.argsort(loss, axis=1, kind="stable")[:, : out.shape[2]]
        out[:, table] = keys[rows, best]
    return out.view(np.int64)


def _same_width(batch: pa.RecordBatch, column: str):
    """Row numbers and matrix of the vectors of each length in a batch."""
    vectors = batch.column(batch.schema.get_field_index(column))
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    start = np.cumsum(sizes) - sizes
    for width in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == width)
        yield rows, flat[start[rows][:, None] + np.arange(width)]


def buckets(vectors: DataFrame, hashes: int) -> DataFrame:
    """``key, own, h, s1, s2``: each vector of ``h, space, embedding`` in its own and probed buckets."""

    def run(batches):
        for batch in batches:
            # Copies would be in the same buckets.
            some = np.unique(batch.column(0).to_numpy(), return_index=True)[1]
            batch = batch.take(pa.array(some))
            h, space = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for rows, matrix in _same_width(batch, "embedding"):
                x = padded(matrix)
                keys, sign = bucket_keys(x, space[rows], hashes), signs(x)
                each = keys.shape[1] * keys.shape[2]
                own = np.zeros(keys.shape, bool)
                own[:, :, 0] = True
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.ravel()),
                        pa.array(own.ravel()),
                        pa.array(np.repeat(h[rows], each)),
                        pa.array(np.repeat(sign[:, 0], each)),
                        pa.array(np.repeat(sign[:, 1], each)),
                    ],
                    ["key", "own", "h", "s1", "s2"],
                )

    return vectors.select("h", "space", "embedding").mapInArrow(
        run, "key bigint, own boolean, h bigint, s1 bigint, s2 bigint"
    )


def _met(df: DataFrame, by: str, node: str, block: int) -> DataFrame:
    """Rows of groups of two and more, placed in ``bin, whole, i, j``: where blocks of a group meet.

    Groups of one block share bins; ``whole`` names the group where it was cut.
    """
    sizes = df.groupBy(by).agg(F.count("*").alias("rows")).where("rows > 1")
    bins = max(shared.task_count(df.sparkSession), 1)
    placed = df.join(sizes, by).withColumn("blocks", F.ceil(F.col("rows") / block).cast("int"))
    return (
        placed.withColumn("block", F.pmod(F.xxhash64(node), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .withColumn("whole", F.when(F.col("blocks") > 1, F.col(by)))
        .withColumn("bin", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64(by), F.lit(bins)).cast("int")).otherwise(-1))
        .drop("rows", "other")
    )


def forest(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the smallest row that it is connected to."""
    least = np.arange(len(linked))
    a, b = np.nonzero(linked)
    while len(a):
        before = least.copy()
        np.minimum.at(least, a, before[b])
        least = least[least]
        if (least == before).all():
            break
    return least


def _near(table: pa.Table) -> pa.Table:
    """``a, b``: a forest of the pairs of each bucket whose signs differ in few places."""
    key, h = table["key"].to_numpy(), table["h"].to_numpy()
    order = np.lexsort((h, key))
    first = np.ones(len(order), bool)
    first[1:] = (key[order][1:] != key[order][:-1]) | (h[order][1:] != h[order][:-1])
    order = order[first]
    key, h = key[order], h[order]
    own, block = (table[c].to_numpy()[order] for c in ("own", "block"))
    sign = np.stack([table["s1"].to_numpy()[order], table["s2"].to_numpy()[order]], 1).view(np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    ends = np.append(starts[1:], len(key))
    many = (ends - starts > 1) & np.logical_or.reduceat(own, starts)
    out = []
    for s, e in zip(starts[many].tolist(), ends[many].tolist(), strict=True):
        x = sign[s:e, None] ^ sign[None, s:e]
        near = np.bitwise_count(x).sum(2, dtype=np.int16) <= MAX_DIFFERENT
        near &= own[s:e, None] | own[None, s:e]
        least = forest(near)
        at = np.flatnonzero(least != np.arange(e - s))
        out.append((h[s:e][at], h[s:e][least[at]]))
    a, b = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (h[:0], h[:0])
    return pa.table({"a": pa.array(a), "b": pa.array(b)})


def candidates(vectors: DataFrame, hashes: int, block: int = BLOCK) -> DataFrame:
    """``a, b``: a forest over the hashes ``h`` of the vectors that share buckets and most signs."""
    met = _met(buckets(vectors, hashes), "key", "h", block)
    return met.groupBy("bin", "whole", "i", "j").applyInArrow(_near, "a bigint, b bigint").distinct()


def _links(table: pa.Table, least: float) -> pa.Table:
    """``node, n, other``: links of each vector to others of its group, and a forest of them."""
    group = table["class"].to_numpy()
    order = np.argsort(group, kind="stable")
    table = table.combine_chunks().take(pa.array(order))
    group = group[order]
    node, copies, block = table["node"].combine_chunks(), table["copies"].to_numpy(), table["block"].to_numpy()
    space = table["label"].combine_chunks().dictionary_encode().indices.to_numpy()
    vectors = pa.RecordBatch.from_arrays([table["embedding"].combine_chunks()], ["embedding"])
    width = np.zeros(len(group), np.int64)
    matrices, place = {}, np.zeros(len(group), np.int64)
    for rows, matrix in _same_width(vectors, "embedding"):
        unit = matrix / np.abs(matrix).max(1, keepdims=True)
        matrices[matrix.shape[1]] = unit / np.linalg.norm(unit, axis=1, keepdims=True)
        width[rows], place[rows] = matrix.shape[1], np.arange(len(rows))
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    found, counts, others = [], [], []
    for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(group)], strict=True):
        linked = np.zeros((e - s, e - s), bool)
        for w in np.unique(width[s:e]).tolist():
            rows = np.flatnonzero(width[s:e] == w)
            unit = matrices[w][place[s:e][rows]]
            linked[np.ix_(rows, rows)] = unit @ unit.T >= least
        linked &= space[s:e, None] == space[None, s:e]
        np.fill_diagonal(linked, False)
        if block[s:e].min() != block[s:e].max():
            # Two blocks meet: each has compared its own elsewhere.
            linked &= block[s:e, None] != block[None, s:e]
        elif table["i"][s].as_py() != table["j"][s].as_py():
            linked[:] = False
        n = linked @ copies[s:e]
        at = np.flatnonzero(n)
        found.append(s + at)
        counts.append(n[at])
        others.append(s + forest(linked)[at])
    return pa.table(
        {
            "node": node.take(pa.array(np.concatenate(found))),
            "n": pa.array(np.concatenate(counts).astype(np.int64)),
            "other": node.take(pa.array(np.concatenate(others))),
        }
    )


def near_duplicates(
    embeddings: DataFrame,
    least: float = SIMILARITY,
    hashes: int | None = None,
    block: int = BLOCK,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    ``n_links`` are other vectors of at least this cosine, ``component_id`` is the smallest id that
    links lead to, and one vector of each component is kept.  ``hashes`` is found from the number of
    vectors.  The signs are made for similarities from 0.9 on.
    """
    kind = embeddings.schema[vector_col].dataType
    number = "float" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "double"
    given = embeddings.select(
        F.col(id_col).alias("vec_id"),
        F.col(vector_col).cast(f"array<{number}>").alias("embedding"),
        F.col(label_col).alias("label"),
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    hashed = given.select(
        "*",
        F.when(usable, F.xxhash64("label", "embedding")).alias("h"),
        F.when(usable, F.xxhash64(F.lit("second"), "embedding", "label")).alias("h2"),
    )
    vectors = hashed.where(F.col("h").isNotNull()).withColumn("space", F.xxhash64("label", F.size("embedding")))
    if hashes is None:
        found = vectors.groupBy("space").agg(F.count("*").alias("n"), F.first(F.size("embedding")).alias("width"))
        wanted = F.ceil(F.log(F.col("n") / BUCKET) / F.log(F.greatest(F.lit(4), 2 * F.col("width"))))
        hashes = max(1, found.agg(F.max(wanted)).first()[0] or 1)

    near = near_dedup.components(candidates(vectors, hashes, block)).withColumnRenamed("id", "h")
    near = shared.stage(near, "candidate-components")
    node = F.concat(F.hex("h"), F.lit("-"), F.hex("h2")).alias("node")
    distinct = vectors.groupBy("h", "h2", "label").agg(
        F.first("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("least_id")
    )
    members = distinct.join(near, "h").select("class", node, "label", "embedding", "copies")
    met = _met(members, "class", "node", block)

    def compare(table):
        return _links(table, least)

    links = shared.stage(
        met.groupBy("bin", "whole", "i", "j").applyInArrow(compare, "node string, n bigint, other string"), "links"
    )
    linked = links.groupBy("node").agg(F.sum("n").alias("n"))
    classes = near_dedup.components(links.select(F.col("node").alias("a"), F.col("other").alias("b")))
    copies = (
        vectors.groupBy("h", "h2")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("least_id"))
        .select(node, "copies", "least_id")
    )
    known = shared.stage(
        copies.join(linked, "node", "left")
        .join(classes.select(F.col("id").alias("node"), "class"), "node", "left")
        .where("copies > 1 or n > 0"),
        "linked-vectors",
    )
    smallest = known.where("class is not null").groupBy("class").agg(F.min("least_id").alias("component"))
    result = known.join(smallest, "class", "left").select(
        "node",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
        F.coalesce("component", "least_id").alias("component"),
    )
    return (
        hashed.select("vec_id", node)
        .join(result, "node", "left")
        .select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
