"""Statistics that a stream of rating events keeps up, so that no job reads the ratings again.

``monthly_profile`` is the state: one row per product and month, however many ratings there are.
Each batch writes the new totals of what it touched as its own partition, and a repeated batch
replaces its partition.  Closed windows of ``trending`` are appended the same way.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import settings
from basketry.operators import statistics, trending
from basketry.sinks.tables import batches, fold_batches, write_batch
from basketry.streaming import run

_TOTALS = "productId bigint, yearmonth int, count bigint, score_sum double"
_WINDOWS = "window_start bigint, window_end bigint, productId bigint, count bigint, score_sum double"
_NUMBERED = ", batch int"


def start_monthly(
    events: DataFrame,
    root: str,
    checkpoint: str,
    once: bool = False,
    zone: str = "UTC",
    fold_every: int = settings.FOLD_EVERY,
):
    """Keep the monthly totals of the events since the checkpoint began under ``root``."""
    ids = events.select(
        F.col("productId").cast("bigint").alias("productId"), F.col("score").cast("double").alias("score"), "timestamp"
    )

    def write(rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, root, settings.MONTHLY_UPDATES, batch_id)
        if batch_id % fold_every == 0:
            fold_batches(
                rows.sparkSession, root, settings.MONTHLY_UPDATES, ["productId", "yearmonth"], _TOTALS + _NUMBERED
            )

    writer = statistics.monthly_profile(ids, zone).writeStream.outputMode("update").foreachBatch(write)
    return run.start(writer, checkpoint, once)


def monthly_updates(spark: SparkSession, root: str) -> DataFrame:
    """Totals of every product and month as of the last batch that touched them."""
    if not batches(spark, root, settings.MONTHLY_UPDATES):
        return spark.createDataFrame([], _TOTALS)
    rows = spark.read.schema(_TOTALS + _NUMBERED).parquet(f"{root}/{settings.MONTHLY_UPDATES}")
    # Several rows of a batch occur where a fold was broken off; they are the same.
    last = F.max_by(F.struct("count", "score_sum"), "batch").alias("last")
    return rows.groupBy("productId", "yearmonth").agg(last).select("productId", "yearmonth", "last.*")


def merged_monthly(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """The stored profile and what a stream added to it."""
    return (
        stored.select(updates.columns)
        .unionByName(updates)
        .groupBy("productId", "yearmonth")
        .agg(F.sum("count").alias("count"), F.sum("score_sum").alias("score_sum"))
    )


def start_trending(events: DataFrame, root: str, checkpoint: str, once: bool = False, **window):
    """Append every closed window to ``TrendingProducts`` under ``root``."""
    ids = events.select(
        F.col("productId").cast("bigint").alias("productId"), F.col("score").cast("double").alias("score"), "timestamp"
    )

    def write(rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, root, settings.TRENDING, batch_id)

    writer = trending.windowed_counts(ids, **window).writeStream.outputMode("append").foreachBatch(write)
    return run.start(writer, checkpoint, once)


def closed_windows(spark: SparkSession, root: str) -> DataFrame:
    if not batches(spark, root, settings.TRENDING):
        return spark.createDataFrame([], _WINDOWS)
    return spark.read.schema(_WINDOWS + _NUMBERED).parquet(f"{root}/{settings.TRENDING}").drop("batch")
