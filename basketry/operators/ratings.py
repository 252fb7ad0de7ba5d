"""Maintenance of the rating table and of the recent-rating queue."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import settings
from basketry.functions import scalars
from basketry.operators import ranking

_KEY = ["userId", "productId"]


def latest_per_key(updates: DataFrame, keys, order) -> DataFrame:
    return ranking.top_per_key(updates, keys, [F.desc(c) for c in order], 1, "place").drop("place")


def upsert(base: DataFrame, updates: DataFrame, order=("timestamp",)) -> DataFrame:
    """Known (user, product): new score, old timestamp.  Unknown: insert.

    Of several updates of one key the last by ``order`` counts; a new key keeps the
    time of its first rating.
    """
    per_key = updates.groupBy(*_KEY).agg(
        F.max_by("score", F.struct(*order)).alias("new_score"),
        F.min("timestamp").alias("new_timestamp"),
    )
    return base.join(per_key, _KEY, "full_outer").select(
        *_KEY,
        F.coalesce("new_score", "score").alias("score"),
        F.coalesce("timestamp", "new_timestamp").alias("timestamp"),
    )


def last_ratings(ratings: DataFrame, order=("timestamp",)) -> DataFrame:
    """A rating table with one row per (user, product): last score, first time."""
    return ratings.groupBy(*_KEY).agg(
        F.max_by("score", F.struct(*order)).alias("score"), F.min("timestamp").alias("timestamp")
    )


def recent_queue(
    events: DataFrame, order=("timestamp",), size: int = settings.QUEUE_SIZE
) -> DataFrame:
    """The newest ``size`` ratings of each user; ``rank`` 1 is the newest."""
    return ranking.top_per_key(events, "userId", [F.desc(c) for c in order], size)


def recent_ratings(queue: DataFrame, n: int = settings.N_RECENT) -> DataFrame:
    """What the scorer reads: queue positions 0 to ``n - 1``."""
    return queue.where(F.col("rank") <= n)


def queue_items(queue: DataFrame) -> DataFrame:
    """One row per user with the queue as ``productId:score`` texts, newest first."""
    item = F.struct("rank", scalars.queue_item("productId", "score").alias("item"))
    return queue.groupBy("userId").agg(
        F.transform(F.array_sort(F.collect_list(item)), lambda i: i["item"]).alias("items")
    )


def parse_queue_items(items: DataFrame) -> DataFrame:
    """Queue texts back to ``(userId, rank, productId, score)``."""
    return items.select("userId", F.posexplode("items").alias("pos", "item")).select(
        "userId",
        (F.col("pos") + 1).alias("rank"),
        scalars.parse_queue_item("item").alias("parsed"),
    ).select("userId", "rank", "parsed.productId", "parsed.score")


def halve_requests(requests: DataFrame) -> DataFrame:
    """Rating requests on the 0-10 scale to stored scores."""
    return requests.withColumn("score", scalars.halve_score("score"))


def rating_log_lines(ratings: DataFrame) -> DataFrame:
    return ratings.select(
        scalars.log_line("userId", "productId", "score", "timestamp").alias("value")
    )


def rate(
    base: DataFrame, queue: DataFrame, requests: DataFrame, order=("timestamp",)
) -> dict[str, DataFrame]:
    """A batch of rating requests: new rating table, new queue and the log lines.

    ``queue`` holds ``(userId, productId, score)`` plus the ``order`` columns.
    """
    ratings = halve_requests(requests)
    columns = list(dict.fromkeys(["userId", "productId", "score", *order]))
    pushed = queue.select(*columns).unionByName(ratings.select(*columns))
    return {
        "ratings": upsert(base, ratings, order),
        "queue": recent_queue(pushed, order),
        "log": rating_log_lines(ratings),
    }


def aggregate_tags(tags: DataFrame) -> DataFrame:
    """User tags to one ``|``-joined text per product."""
    return (
        tags.select("productId", "tag")
        .distinct()
        .groupBy("productId")
        .agg(
            F.array_join(F.array_sort(F.collect_list("tag")), settings.MULTI_VALUE_SEPARATOR).alias(
                "tags"
            )
        )
    )
