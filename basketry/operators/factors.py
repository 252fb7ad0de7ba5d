"""Predictions of given factors: dot products of pairs, in tiles of users and products.

Users and products are hashed into blocks of bounded size.  A pair goes to its tile as it is, and
factors go once to each tile of their block, so no pair carries a vector through a shuffle.  A
task reads a tile's vectors first and then streams its pairs.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from basketry import settings, shared

shared.ship(__name__)

_EXPANDED = 500_000  # pairs of vectors at once ...
_GATHERED = 5_000  # ... and those whose numbers are


def prediction(rank: int | None) -> str:
    """Name of the column of predictions by the first ``rank`` factors."""
    return "__prediction" if rank is None else f"__prediction_{rank}"


def predictions(pairs: DataFrame, users: DataFrame, items: DataFrame, ranks=(None,)) -> DataFrame:
    """``pairs`` (userId, productId, …) joined with both factors (id, features), and the dot products.

    Rows are those of an inner join: repeated ids give a row each, unknown and null ones none.  A
    prediction is null where a vector is null, has a null, or the two differ in length.
    """
    spark = pairs.sparkSession
    sides = []
    # Blocks enough to give all cores a tile: a vector is copied once for each block of the other side.
    least = math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism))
    for vectors in (users, items):
        known = vectors.where(F.col("id").isNotNull())
        number = known.schema["features"].dataType
        if not (isinstance(number, ArrayType) and isinstance(number.elementType, (FloatType, DoubleType))):
            known = known.withColumn("features", F.col("features").cast("array<double>"))
        else:
            known = known.select("id", "features")
        count, dimensions = known.agg(F.count(F.lit(1)), F.max(F.size("features"))).first()
        sides.append((known, max(least, -(-count * max(dimensions or 1, 1) // settings.TILE_NUMBERS))))
    (left, rows), (right, columns) = sides

    def block(key: str, blocks: int):
        return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(blocks))

    own = [f.name for f in pairs.schema if f.name not in ("userId", "productId")]
    keys = {"userId": F.col("userId").cast("bigint"), "productId": F.col("productId").cast("bigint")}
    placed = pairs.where("userId is not null and productId is not null").select(
        (block("userId", rows) * columns + block("productId", columns)).alias("tile"),
        F.lit(2).alias("kind"),
        *[c.alias(name) for name, c in keys.items()],
        *own,
    )
    for kind, (vectors, mine, others) in enumerate(((left, rows, columns), (right, columns, rows))):
        copies = vectors.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        low, high = (block("id", mine), F.col("other")) if kind == 0 else (F.col("other"), block("id", mine))
        placed = placed.unionByName(
            copies.select(
                (low * columns + high).alias("tile"),
                F.lit(kind).alias("kind"),
                F.col("id").cast("bigint").alias("userId"),
                F.col("features").alias("__features"),
            ),
            allowMissingColumns=True,
        )
    out = [f"`{n}` bigint" for n in ("productId", "userId")]
    out += [f"`{n}` {pairs.schema[n].dataType.simpleString()}" for n in own]
    out += [f"`{prediction(r)}` double" for r in ranks]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, sides = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column("tile").to_numpy() * 3 + batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.diff(group)) + 1
            for start, stop in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows], strict=True):
                key, kind = divmod(int(group[start]), 3)
                if key != tile:
                    tile, sides = key, (_Side(), _Side())
                part = batch.slice(start, stop - start)
                if kind < 2:
                    sides[kind].add(part)
                else:
                    yield from _predicted(part, *sides, ["productId", "userId", *own], ranks)

    found = (
        placed.repartition(shared.task_count(spark, rows * columns), "tile")
        .sortWithinPartitions("tile", "kind")
        .mapInArrow(predict, ", ".join(out))
    )
    kinds = {n: pairs.schema[n].dataType for n in ("productId", "userId")}
    return found.withColumns({n: F.col(n).cast(kind) for n, kind in kinds.items()})


class _Side:
    """The vectors of one side of a tile, by id."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.ids = None

    def add(self, rows: pa.RecordBatch) -> None:
        vectors = rows.column("__features")
        lengths = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(vectors), -1), np.int64)
        flat = vectors.flatten()
        at = np.repeat(np.arange(len(lengths)), np.maximum(lengths, 0))
        # The place of a vector's first null, or its end.
        whole = np.maximum(lengths, 0)
        place = np.arange(len(at)) - np.repeat(np.cumsum(whole) - whole, whole)
        null = np.asarray(flat.is_null())
        np.minimum.at(whole, at[null], place[null])
        self.parts.append((rows.column("userId").to_numpy(), lengths, whole, at, place, flat.to_numpy(zero_copy_only=False)))

    def close(self) -> None:
        if self.ids is not None:
            return
        ids, lengths, whole = (
            np.concatenate([p[i] for p in self.parts]) if self.parts else np.empty(0, np.int64) for i in range(3)
        )
        matrix = np.zeros((len(ids), max(0, int(lengths.max(initial=0)))))
        first = 0
        for own, _, _, at, place, flat in self.parts:
            matrix[first + at, place] = flat
            first += len(own)
        order = np.argsort(ids, kind="stable")
        self.ids, self.matrix, self.parts = ids[order], matrix[order], []
        self.lengths, self.whole = lengths[order], whole[order]


def _predicted(rows: pa.RecordBatch, users: _Side, items: _Side, names: list[str], ranks) -> Iterator[pa.RecordBatch]:
    users.close()
    items.close()
    columns = rows.select(names)
    for start in range(0, rows.num_rows, _EXPANDED):
        part = columns.slice(start, _EXPANDED)
        user, product = part.column("userId").to_numpy(), part.column("productId").to_numpy()
        u, v = np.searchsorted(users.ids, user), np.searchsorted(items.ids, product)
        of_user = np.searchsorted(users.ids, user, "right") - u
        of_item = np.searchsorted(items.ids, product, "right") - v
        # A pair meets every vector of its user with every vector of its product.
        times = of_user * of_item
        done = np.r_[0, np.cumsum(times)]
        low = 0
        while low < len(times):
            high = int(np.searchsorted(done, done[low] + _EXPANDED, "right")) - 1
            high = min(max(high, low + 1), len(times))
            at = np.repeat(np.arange(low, high), times[low:high])
            nth = np.arange(len(at)) - (done[at] - done[low])
            low = high
            if not len(at):
                continue
            scores = _dots(users, u[at] + nth // of_item[at], items, v[at] + nth % of_item[at], ranks)
            taken = part.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, *scores], [*taken.schema.names, *[prediction(r) for r in ranks]]
            )


def _dots(users: _Side, u: np.ndarray, items: _Side, v: np.ndarray, ranks) -> list[pa.Array]:
    """Dot products of rows ``u`` and ``v`` by the first ``rank`` factors, summed from the first on."""
    width = min(users.matrix.shape[1], items.matrix.shape[1])
    ends = {r: width if r is None else min(r, width) for r in ranks}
    sums = {end: np.zeros(len(u)) for end in ends.values()}
    for start in range(0, len(u) if width else 0, _GATHERED):
        part = slice(start, start + _GATHERED)
        running = np.cumsum(users.matrix[u[part], :width] * items.matrix[v[part], :width], axis=1)
        for end, total in sums.items():
            if end:
                total[part] = running[:, end - 1]
    out = []
    for r in ranks:
        a, b = users.lengths[u], items.lengths[v]
        a, b = (np.minimum(x, r) if r is not None else x for x in (a, b))
        missing = (a < 0) | (b < 0) | (a != b) | (users.whole[u] < a) | (items.whole[v] < b)
        out.append(pa.array(sums[ends[r]], mask=missing))
    return out
