"""Top-k per key, and packing recommendation rows into lists and back."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry import settings, shared

shared.ship(__name__)


def top_per_key(df: DataFrame, keys, order, k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of every key.

    The ``row_number() <= k`` filter is planned as a window group limit, so each
    map task keeps ``k`` rows per key before the shuffle: a hot key never travels whole.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def rank_recs(df: DataFrame, key: str, k: int, item="productId", score="score") -> DataFrame:
    return top_per_key(df, key, [F.desc(F.round(score, 9)), F.asc(item)], k)


def pack_recs(ranked: DataFrame, key: str, item="productId", score="score") -> DataFrame:
    """Ranked rows (at most k per key) to one row per key with an ordered list."""
    entry = F.struct("rank", F.col(item).alias("productId"), F.col(score).alias("score"))
    ordered = F.array_sort(F.collect_list(entry))
    return ranked.groupBy(key).agg(
        F.transform(
            ordered, lambda e: F.struct(e["productId"].alias("productId"), e["score"].alias("score"))
        ).alias("recs")
    )


def list_rank(
    df: DataFrame, key: str, item="productId", score="score", rank: str = "rank"
) -> DataFrame:
    """The rank of every row in its whole list, best first, however long the list is.

    Rows are range-partitioned in list order, so a list of any length is cut over many
    tasks.  A row's rank is its place in its own range plus what the list has in the ranges
    before, which takes one small count per range and key.
    """
    order = [F.desc(F.round(score, 9)), F.asc(item)]
    # Finding the ranges reads the lists once more: staged, they are not worked out twice.
    lists = shared.stage(df, "lists")
    sorted_ranges = (
        lists.repartitionByRange(F.col(key), *order)
        .sortWithinPartitions(F.col(key), *order)
        .withColumn("range", F.spark_partition_id())
    )
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sorted_ranges.schema)
    ranges = shared.stage(
        sorted_ranges.mapInArrow(_numbered(df.columns.index(key)), f"{names}, place bigint"), "ranges"
    )
    sizes = ranges.groupBy(key, "range").agg(F.max("place").alias("size"))
    before = Window.partitionBy(key).orderBy("range")
    offsets = sizes.select(key, "range", (F.sum("size").over(before) - F.col("size")).alias("offset"))
    return (
        ranges.join(offsets, [key, "range"])
        .withColumn(rank, (F.col("offset") + F.col("place")).cast("int"))
        .select(*df.columns, rank)
    )


def _numbered(key: int):
    """Number the rows of each key in a sorted partition, from 1, batch after batch."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, done = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            new = np.flatnonzero(np.r_[last is None or keys[0] != last, keys[1:] != keys[:-1]])
            starts = np.zeros(len(keys), np.int64)
            starts[new] = new
            place = np.arange(len(keys)) - np.maximum.accumulate(starts) + 1
            place[: new[0] if len(new) else len(keys)] += done
            last, done = keys[-1], int(place[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(place, pa.int64())], [*batch.schema.names, "place"]
            )

    return number


def pack_pages(
    df: DataFrame, key: str, item="productId", score="score", page_size=settings.PAGE_SIZE
) -> DataFrame:
    """Whole, unbounded lists as pages of at most ``page_size`` entries.

    Page ``n`` holds ranks ``n * page_size + 1 ...``; no list is cut and no task
    holds more than one page.
    """
    ranked = list_rank(df, key, item, score).withColumn(
        "page", F.floor((F.col("rank") - 1) / page_size).cast("int")
    )
    entry = F.struct("rank", F.col(item).alias("productId"), F.col(score).alias("score"))
    return ranked.groupBy(key, "page").agg(
        F.transform(
            F.array_sort(F.collect_list(entry)),
            lambda e: F.struct(e["productId"].alias("productId"), e["score"].alias("score")),
        ).alias("recs")
    )


def unpack_recs(packed: DataFrame, key: str) -> DataFrame:
    """Lists back to rows; ``rank`` is the position in the list, from 1."""
    return packed.select(key, F.posexplode("recs").alias("pos", "rec")).select(
        key,
        (F.col("pos") + 1).alias("rank"),
        F.col("rec.productId").alias("productId"),
        F.col("rec.score").alias("score"),
    )


def unpack_pages(pages: DataFrame, key: str, page_size: int = settings.PAGE_SIZE) -> DataFrame:
    """Pages of ``pack_pages`` back to rows, ``rank`` being the place in the whole list."""
    return pages.select(key, "page", F.posexplode("recs").alias("pos", "rec")).select(
        key,
        (F.col("page") * page_size + F.col("pos") + 1).cast("int").alias("rank"),
        F.col("rec.productId").alias("productId"),
        F.col("rec.score").alias("score"),
    )


def empty_recs():
    return F.array().cast("array<struct<productId:bigint,score:double>>")
