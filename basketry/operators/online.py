"""Scoring of live recommendations, as a batch operator over rating events.

No table of all product pairs is needed.  A similarity answers two questions: the best
neighbours of the trigger products, each list only as deep as some user needs it, and the
scores of given (candidate, recent) pairs.  It may rest on latent factors, on tag profiles, or
on a stored table ``(product1, product2, score)`` in both directions with whole lists.
"""

from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import settings, shared
from basketry.operators import content, dense, ranking


class Similarity(Protocol):
    def neighbours(self, products: DataFrame, k: int) -> DataFrame:
        """``(product1, place, product2, score)``: the best ``k`` of each ``productId``."""

    def scores(self, pairs: DataFrame) -> DataFrame:
        """``(product1, product2, score)`` of those pairs that have one."""


class StoredLists:
    """Similarity lists of a stored table."""

    def __init__(self, sim: DataFrame):
        self.sim = sim.select("product1", "product2", "score")

    def neighbours(self, products: DataFrame, k: int) -> DataFrame:
        wanted = products.select(F.col("productId").alias("product1"))
        order = [F.desc(F.round("score", 9)), F.asc("product2")]
        lists = self.sim.join(wanted, "product1", "left_semi")
        return ranking.top_per_key(lists, "product1", order, k, "place")

    def scores(self, pairs: DataFrame) -> DataFrame:
        return self.sim.join(pairs.select("product1", "product2").distinct(), ["product1", "product2"])


class FactorVectors:
    """Cosine of item vectors ``(id, features)``, above ``min_sim``."""

    def __init__(self, vectors: DataFrame, min_sim: float = settings.MIN_SIMILARITY):
        self.vectors, self.min_sim = vectors, min_sim

    def neighbours(self, products: DataFrame, k: int) -> DataFrame:
        wanted = products.select(F.col("productId").alias("id"))
        asked = self.vectors.join(wanted, "id", "left_semi")
        found = dense.best_matches(asked, self.vectors, k, self.min_sim)
        return found.withColumnRenamed("rank", "place")

    def scores(self, pairs: DataFrame) -> DataFrame:
        return dense.pair_scores(pairs, self.vectors).where(F.col("score") > self.min_sim)


class TagProfiles:
    """Cosine of tag profiles (``content``), above ``min_sim``."""

    def __init__(self, words: DataFrame, min_sim: float = settings.MIN_SIMILARITY):
        self.profiles, self.min_sim = content.Profiles(words), min_sim

    def neighbours(self, products: DataFrame, k: int) -> DataFrame:
        found = content.top_similar(self.profiles, k, self.min_sim, requests=products)
        return found.select(
            F.col("productId").alias("product1"),
            F.col("rank").alias("place"),
            F.col("recId").alias("product2"),
            "score",
        )

    def scores(self, pairs: DataFrame) -> DataFrame:
        return content.pair_scores(self.profiles, pairs).where(F.col("score") > self.min_sim)


def _similarity(sim: DataFrame | Similarity) -> Similarity:
    return StoredLists(sim) if isinstance(sim, DataFrame) else sim


def latest_event(events: DataFrame, order=("timestamp", "productId")) -> DataFrame:
    """The last event of every user."""
    return ranking.top_per_key(events, "userId", [F.desc(c) for c in order], 1, "place").drop(
        "place"
    )


def _by_level(sim: Similarity, wanted: DataFrame) -> DataFrame:
    """Lists of ``product1``, those that need about the same depth (``level``) asked for together.

    A user who rated very many products so deepens the list of few triggers, not of all.  A level is
    sixteen times as deep as the one before, so there are a handful at most.
    """
    levels = wanted.groupBy("level").agg(F.max("most")).collect()
    parts = [
        sim.neighbours(wanted.where(F.col("level") == level).select(F.col("product1").alias("productId")), most)
        for level, most in levels or [(0, 1)]
    ]
    return reduce(DataFrame.unionByName, parts)


def candidates(
    triggers: DataFrame,
    rated: DataFrame,
    sim: DataFrame | Similarity,
    k: int = settings.N_CANDIDATES,
) -> DataFrame:
    """``(userId, rank, candidate, score)``: unrated products most similar to the trigger.

    ``triggers`` is one (userId, productId) per user, ``rated`` all (userId, productId).
    """
    users = triggers.select("userId", F.col("productId").alias("product1"))
    seen = shared.stage(
        rated.select("userId", "productId")
        .join(users.select("userId"), "userId", "left_semi")
        .distinct(),
        "seen",
    )
    # A user who rated r products finds k unrated ones among the first k + r of a list.
    depth = seen.groupBy("userId").agg(F.count(F.lit(1)).alias("n_seen"))
    bounded = shared.stage(
        users.join(depth, "userId", "left").withColumn("depth", F.coalesce("n_seen", F.lit(0)) + k),
        "triggers",
    )
    # Lists are cut to what some user of the trigger needs before they meet the users.
    wanted = shared.stage(
        bounded.groupBy("product1")
        .agg(F.max("depth").alias("most"))
        .withColumn("level", F.greatest(F.ceil(F.log2(F.col("most") / k) / 4 - 1), F.lit(0)).cast("int")),
        "wanted",
    )
    lists = (
        _by_level(_similarity(sim), wanted)
        .join(wanted.drop("level"), "product1")
        .where(F.col("place") <= F.col("most"))
        .drop("most")
    )
    near = (
        bounded.join(lists, "product1")
        .where(F.col("place") <= F.col("depth"))
        .select("userId", F.col("product2").alias("candidate"), "score")
    )
    unseen = near.join(
        seen.withColumnRenamed("productId", "candidate"), ["userId", "candidate"], "left_anti"
    )
    return ranking.top_per_key(
        unseen, "userId", [F.desc(F.round("score", 9)), F.asc("candidate")], k
    ).select("userId", "rank", "candidate", "score")


def score_candidates(
    candidates: DataFrame,
    recents: DataFrame,
    sim: DataFrame | Similarity,
    min_sim: float = settings.ONLINE_MIN_SIMILARITY,
    positive_above: float = settings.POSITIVE_ABOVE,
) -> DataFrame:
    """``(userId, productId, score)`` of candidates with a recent rating close enough.

    ``recents`` is (userId, productId, score), one row per queue entry.
    """
    pairs = shared.stage(
        candidates.select("userId", F.col("candidate").alias("product1")).join(
            recents.select(
                "userId", F.col("productId").alias("product2"), F.col("score").alias("rating")
            ),
            "userId",
        ),
        "candidate-recent",
    )
    close = _similarity(sim).scores(pairs).where(F.col("score") > min_sim)
    liked = F.col("rating") > positive_above
    return (
        pairs.join(close, ["product1", "product2"])
        .groupBy("userId", F.col("product1").alias("productId"))
        .agg(
            F.avg(F.col("score") * F.col("rating")).alias("base"),
            F.count_if(liked).alias("up"),
            F.count_if(~liked).alias("down"),
        )
        .select(
            "userId",
            "productId",
            (
                F.col("base")
                + F.log2(F.greatest("up", F.lit(1)))
                - F.log2(F.greatest("down", F.lit(1)))
            ).alias("score"),
        )
    )


def recommend(
    triggers: DataFrame,
    recents: DataFrame,
    rated: DataFrame,
    sim: DataFrame | Similarity,
    **options,
) -> DataFrame:
    """One row per triggering user; a user without scored candidates has an empty list."""
    found = candidates(triggers, rated, sim, options.get("k", settings.N_CANDIDATES))
    scores = score_candidates(found, recents, sim)
    ranked = ranking.rank_recs(scores, "userId", settings.N_CANDIDATES)
    return (
        triggers.select("userId")
        .distinct()
        .join(ranking.pack_recs(ranked, "userId"), "userId", "left")
        .withColumn("recs", F.coalesce("recs", ranking.empty_recs()))
    )


def replace_recs(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """``batch`` replaces the rows of its users; other users keep theirs."""
    return existing.join(batch.select("userId"), "userId", "left_anti").unionByName(batch)
