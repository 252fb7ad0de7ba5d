"""Trending products: counts by sliding windows of event time."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry import settings


def windowed_counts(
    events: DataFrame,
    length: str = settings.TREND_WINDOW,
    slide: str = settings.TREND_SLIDE,
    delay: str = settings.TREND_DELAY,
) -> DataFrame:
    """``window_start, window_end, productId, count, score_sum`` of rating events, in epoch seconds.

    Windows are aligned to 1970.  In a stream a window is closed once an event that is ``delay``
    younger than its end was seen by an earlier batch; what comes later for it is dropped, while the
    windows that are still open count it.  A batch job counts everything.  An event without a time
    is in no window.
    """
    timed = events.withColumn("event_time", F.timestamp_seconds("timestamp"))
    return (
        timed.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", length, slide), "productId")
        .agg(F.count("productId").alias("count"), F.sum("score").alias("score_sum"))
        .select(
            F.unix_timestamp("window.start").alias("window_start"),
            F.unix_timestamp("window.end").alias("window_end"),
            "productId",
            "count",
            "score_sum",
        )
    )


def top_per_window(counts: DataFrame, n: int = settings.TREND_TOP) -> DataFrame:
    """``rank`` from 1 of the ``n`` most rated products of every window.

    Map tasks keep ``n`` rows a window before the shuffle.
    """
    order = Window.partitionBy("window_start").orderBy(F.desc("count"), "productId")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
