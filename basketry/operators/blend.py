"""Combining recommendation lists of several sources."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import settings, shared
from basketry.operators import ranking


def normalised(recs: DataFrame, key: str = "userId") -> DataFrame:
    """Scores divided by the best absolute score of their list, so sources compare."""
    best = recs.groupBy(key).agg(F.max(F.abs("score")).alias("best"))
    share = F.when(F.col("best") > 0, F.col("score") / F.col("best")).otherwise(F.lit(0.0))
    return recs.join(best, key).select(key, "productId", share.alias("score"))


def blend(
    sources: dict[str, tuple[DataFrame, float]], k: int = settings.USER_TOP, key: str = "userId"
) -> DataFrame:
    """Weighted sum of normalised scores: ``(key, rank, productId, score)``.

    ``sources`` maps a name to (recommendation rows, weight).
    """
    return ranking.rank_recs(_weighted_sum(sources, key), key, k).select(key, "rank", "productId", "score")


def _weighted_sum(sources: dict[str, tuple[DataFrame, float]], key: str) -> DataFrame:
    weighted = [
        normalised(rows, key).withColumn("score", F.col("score") * F.lit(float(weight)))
        for rows, weight in sources.values()
    ]
    return reduce(DataFrame.unionByName, weighted).groupBy(key, "productId").agg(F.sum("score").alias("score"))


def blend_by_trigger(
    triggers: DataFrame,
    of_trigger: dict[str, tuple[DataFrame, float]],
    of_user: dict[str, tuple[DataFrame, float]],
    k: int = settings.USER_TOP,
    key: str = "userId",
) -> DataFrame:
    """As ``blend`` where some lists depend on the user's ``trigger`` alone.

    ``triggers`` has one row ``key, trigger`` per user; lists in ``of_trigger`` are keyed by ``trigger``.
    Those are summed once for each trigger.  A user needs no more of the sum than the best ``k`` and
    one more for each product with a score of the user's own, whose places are looked up.
    """
    known = shared.stage(triggers.select(key, "trigger").dropna(), "triggers")
    sums = shared.stage(_weighted_sum(of_trigger, "trigger"), "trigger-sums")
    own = shared.stage(_weighted_sum(of_user, key), "own-sums")
    most = own.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    leading = ranking.rank_recs(sums, "trigger", k + most).drop("rank")
    others = known.join(leading, "trigger").select(key, "productId", "score").join(own, [key, "productId"], "left_anti")
    both = (
        own.join(known, key, "left")
        .join(sums.withColumnRenamed("score", "shared"), ["trigger", "productId"], "left")
        .select(key, "productId", (F.col("score") + F.coalesce("shared", F.lit(0.0))).alias("score"))
    )
    return ranking.rank_recs(others.unionByName(both), key, k).select(key, "rank", "productId", "score")


def merge_stream_recs(
    earlier: DataFrame, latest: DataFrame, k: int = settings.USER_TOP, key: str = "userId"
) -> DataFrame:
    """Earlier and new recommendation rows together; the higher score of a product wins."""
    merged = (
        earlier.select(key, "productId", "score")
        .unionByName(latest.select(key, "productId", "score"))
        .groupBy(key, "productId")
        .agg(F.max("score").alias("score"))
    )
    return ranking.rank_recs(merged, key, k).select(key, "rank", "productId", "score")
