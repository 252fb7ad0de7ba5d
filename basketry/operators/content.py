"""Content similarity: TF-IDF weights over product tags and cosine above a threshold.

Products with the same bag of tag words form one *profile*.  Weights, candidates and
cosines are worked out per profile, so a group of copies costs one vector however many
products share it.

Pairs come from an exact prefix filter.  Every vector's terms are ordered by one global
order, rare terms first.  A term belongs to the vector's prefix as long as the rest of
the vector, from this term on, has at least ``min_sim`` of the norm.  If two vectors share
no prefix term, their dot product lies in a rest shorter than ``min_sim`` of one of them,
so their cosine stays below the threshold.  Frequent terms almost never are prefix
terms.  Inside the group of one prefix term the vectors are multiplied in blocks of
bounded size and only pairs above the threshold leave the task, each from the group of
the first prefix term the two vectors share.
"""

import numpy as np
import pandas as pd
from pyspark.ml.feature import Tokenizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry import settings, shared
from basketry.functions import scalars
from basketry.operators import ranking

shared.ship(__name__)

_PAIRS = "profile1 bigint, profile2 bigint, score double"
_VOCABULARY_CHUNK = 4096


def tokens(products: DataFrame) -> DataFrame:
    """``(productId, words)``: lower-cased tag words."""
    text = products.select("productId", scalars.normalise_tags("tags").alias("text"))
    return Tokenizer(inputCol="text", outputCol="words").transform(text).drop("text")


def hashed_tokens(products: DataFrame, num_features=settings.NUM_FEATURES) -> DataFrame:
    """As ``tokens``, each word replaced by its hash bucket."""
    bucket = F.transform("words", lambda word: scalars.term_bucket(word, num_features).cast("string"))
    return tokens(products).select("productId", bucket.alias("words"))


class Profiles:
    """Distinct tag vectors and who has them.

    ``members``: productId, profileId (the smallest product id with that bag);
    ``weights``: profileId, term, df, weight.
    """

    def __init__(self, words: DataFrame):
        tagged = shared.stage(
            words.select("productId", F.array_sort("words").alias("words")), "words"
        )
        n_products = tagged.count()
        profiles = shared.stage(
            tagged.groupBy("words").agg(
                F.min("productId").alias("profileId"), F.count(F.lit(1)).alias("copies")
            ),
            "profiles",
        )
        self.members = tagged.join(profiles, "words").select("productId", "profileId")
        frequencies = (
            profiles.select("profileId", "copies", F.explode("words").alias("term"))
            .groupBy("profileId", "copies", "term")
            .agg(F.count(F.lit(1)).alias("tf"))
        )
        document_counts = frequencies.groupBy("term").agg(F.sum("copies").alias("df"))
        idf = F.log((F.lit(n_products) + 1.0) / (F.col("df") + 1.0))
        # A term of every product weighs ln(1) = 0 and cannot add to a dot product.
        self.weights = (
            frequencies.join(document_counts, "term")
            .select("profileId", "term", "df", (F.col("tf") * idf).alias("weight"))
            .where(F.col("weight") > 0)
        )


    def of(self, requests: DataFrame | None) -> DataFrame | None:
        """The profiles of the requested products, staged: they prune the pairs of all others."""
        if requests is None:
            return None
        asked = requests.select("productId").distinct()
        found = self.members.join(asked, "productId", "left_semi").select("profileId").distinct()
        return shared.stage(found, "asked")


def tfidf_weights(words: DataFrame) -> DataFrame:
    """``(productId, term, weight)`` of every product; zero weights are left out."""
    profiles = Profiles(words)
    return profiles.members.join(profiles.weights, "profileId").select(
        "productId", "term", "weight"
    )


def profile_similarity(
    weights: DataFrame,
    min_sim: float = settings.MIN_SIMILARITY,
    block: int | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """``(profile1, profile2, score)``, ``profile1 < profile2``, score above ``min_sim``.

    With ``wanted`` (profileId) only pairs with one of those profiles: terms that none of
    them has in its prefix make no group.
    """
    vectors = _prefixed_vectors(weights, min_sim)
    if wanted is not None:
        asked = wanted.select("profileId", F.lit(True).alias("asked"))
        vectors = vectors.join(asked, "profileId", "left")
    else:
        vectors = vectors.withColumn("asked", F.lit(True))
    vectors = shared.stage(vectors, "vectors")
    holders = vectors.select(
        "profileId", F.size("terms").alias("length"), F.explode("prefix").alias("term")
    )
    if wanted is not None:
        terms = vectors.where("asked").select(F.explode("prefix").alias("term")).distinct()
        holders = holders.join(terms, "term", "left_semi")
    groups = (
        holders.groupBy("term")
        .agg(F.count(F.lit(1)).alias("size"), F.sum("length").alias("length"))
        .where(F.col("size") > 1)
        .withColumn(
            "blocks",
            # A term's blocks are bounded in vectors and, by their mean length, in terms.
            F.ceil(
                F.greatest(
                    F.col("size") / (block or settings.TILE_PROFILES),
                    F.col("length") / settings.TILE_TERMS,
                )
            ).cast("int"),
        )
    )
    # A hot term's group is cut in blocks; its vectors go to every pair of blocks.
    placed = (
        holders.join(groups.select("term", "blocks"), "term")
        .withColumn("own", F.pmod(F.xxhash64("profileId"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "profileId",
            "term",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
        )
    )
    return (
        placed.join(vectors, "profileId")
        .repartition(shared.task_count(weights.sparkSession), "term", "low", "high")
        .groupBy("term", "low", "high")
        .applyInPandas(_tile_function(min_sim), _PAIRS)
    )


def _prefixed_vectors(weights: DataFrame, min_sim: float) -> DataFrame:
    """Unit vectors as arrays in global term order, with their prefix terms."""
    per_vector = Window.partitionBy("profileId")
    ahead = per_vector.orderBy("df", "term").rowsBetween(0, Window.unboundedFollowing)
    square = F.col("weight") * F.col("weight")
    # The margin keeps vectors that rounding puts just below the bound.
    enough = (1 - 1e-9) * min_sim * min_sim
    entry = F.struct("df", "term", F.col("unit").alias("weight"), "in_prefix")
    ordered = F.array_sort(F.collect_list(entry))
    return (
        weights.withColumn("rest", F.sum(square).over(ahead))
        .withColumn("norm2", F.sum(square).over(per_vector))
        .withColumn("unit", F.col("weight") / F.sqrt("norm2"))
        .withColumn("in_prefix", F.col("rest") >= F.lit(enough) * F.col("norm2"))
        .groupBy("profileId")
        .agg(ordered.alias("entries"))
        .select(
            "profileId",
            F.col("entries.term").alias("terms"),
            F.col("entries.weight").alias("units"),
            F.col("entries.df").alias("dfs"),
            F.transform(
                F.filter("entries", lambda e: e["in_prefix"]), lambda e: e["term"]
            ).alias("prefix"),
        )
    )


def _tile_function(min_sim: float):
    def similar(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _similar_in_tile(key, rows, min_sim)

    return similar


def _similar_in_tile(key: tuple, rows: pd.DataFrame, min_sim: float) -> pd.DataFrame:
    """Pairs of two blocks of one term's holders, at most ``2 * block`` vectors."""
    term, low, high = key
    lengths = rows.terms.str.len().to_numpy()
    owner = np.repeat(np.arange(len(rows)), lengths)
    terms = np.concatenate(rows.terms.to_list())
    units = np.concatenate(rows.units.to_list())
    dfs = np.concatenate(rows.dfs.to_list())
    place = np.arange(len(terms)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    in_prefix = place < np.repeat(rows.prefix.str.len().to_numpy(), lengths)
    term_df = dfs[np.flatnonzero(terms == term)[0]]
    earlier = in_prefix & ((dfs < term_df) | ((dfs == term_df) & (terms < term)))

    side = rows.side.to_numpy()
    first = np.flatnonzero(side == 0)
    second = first if low == high else np.flatnonzero(side == 1)
    dots = _products(owner, terms, units, len(rows), first, second)
    similar = dots > min_sim
    asked = rows.asked.to_numpy() == True  # noqa: E712  null where a profile isn't asked for
    similar &= asked[first][:, None] | asked[second][None, :]
    if earlier.any():
        # Such a pair is reported by the group of the earlier shared prefix term.
        ones = np.ones(int(earlier.sum()))
        similar &= _products(owner[earlier], terms[earlier], ones, len(rows), first, second) == 0
    ids = rows.profileId.to_numpy()
    at1, at2 = np.nonzero(similar)
    p, q, score = ids[first[at1]], ids[second[at2]], dots[at1, at2]
    if low == high:
        p, q, score = (x[p < q] for x in (p, q, score))
    return pd.DataFrame(
        {"profile1": np.minimum(p, q), "profile2": np.maximum(p, q), "score": score}
    )


def _products(owner, terms, values, n, first, second) -> np.ndarray:
    """Dot products of sparse rows ``first`` with rows ``second``, a vocabulary slice at a time."""
    codes, vocabulary = pd.factorize(terms)
    result = np.zeros((len(first), len(second)))
    for start in range(0, len(vocabulary), _VOCABULARY_CHUNK):
        at = (codes >= start) & (codes < start + _VOCABULARY_CHUNK)
        dense = np.zeros((n, min(_VOCABULARY_CHUNK, len(vocabulary) - start)))
        dense[owner[at], codes[at] - start] = values[at]
        result += dense[first] @ dense[second].T
    return result


def directed(pairs: DataFrame) -> DataFrame:
    """Every profile pair in both directions, and every profile with itself."""
    way = F.explode(
        F.array(
            F.struct(F.col("profile1").alias("a"), F.col("profile2").alias("b")),
            F.struct(F.col("profile2").alias("a"), F.col("profile1").alias("b")),
        )
    )
    return pairs.select("score", way.alias("way")).select(
        F.col("way.a").alias("profile1"), F.col("way.b").alias("profile2"), "score"
    )


def _with_self(pairs: DataFrame, profiles: Profiles) -> DataFrame:
    # Copies of one another have cosine 1, unless the vector has no weight at all.
    own = profiles.weights.select("profileId").distinct().select(
        F.col("profileId").alias("profile1"),
        F.col("profileId").alias("profile2"),
        F.lit(1.0).alias("score"),
    )
    return directed(pairs).unionByName(own)


def similar_products(
    words: DataFrame,
    min_sim: float = settings.MIN_SIMILARITY,
    requests: DataFrame | None = None,
    decimals: int | None = None,
) -> DataFrame:
    """``(product1, product2, score)`` in both directions: the whole lists.

    With ``requests`` (productId) only the lists of those products are written out; with ``decimals``
    scores are rounded, once for all products of two profiles.
    """
    profiles = Profiles(words)
    pairs = profile_similarity(profiles.weights, min_sim, wanted=profiles.of(requests))
    return expand(profiles, pairs, requests, decimals)


def expand(
    profiles: Profiles, pairs: DataFrame, requests: DataFrame | None = None, decimals: int | None = None
) -> DataFrame:
    """The pairs of products of pairs of profiles.

    Members travel in chunks of bounded size, so a pair of profiles is a few rows until its products meet.
    """
    members = profiles.members
    wanted = members if requests is None else members.join(requests, "productId", "left_semi")
    score = F.col("score") if decimals is None else F.round("score", decimals)
    return (
        _with_self(pairs, profiles)
        .withColumn("score", score)
        .join(_chunks(wanted, "1"), "profile1")
        .join(_chunks(members, "2"), "profile2")
        .select("score", F.explode("products1").alias("product1"), "products2")
        .select("product1", F.explode("products2").alias("product2"), "score")
        .where(F.col("product1") != F.col("product2"))
    )


def _chunks(members: DataFrame, side: str) -> DataFrame:
    """``profile, products``: the members of each profile, about ``MEMBERS`` to a row; null ids have no pairs."""
    some = members.where(F.col("productId").isNotNull())
    chunks = some.groupBy("profileId").agg(F.ceil(F.count(F.lit(1)) / settings.MEMBERS).alias("chunks"))
    return (
        some.join(chunks, "profileId")
        .groupBy(
            F.col("profileId").alias(f"profile{side}"),
            F.pmod(F.xxhash64("productId"), F.col("chunks")).alias("chunk"),
        )
        .agg(F.collect_list("productId").alias(f"products{side}"))
        .drop("chunk")
    )


def similar_pages(
    words: DataFrame,
    page_size: int = settings.PAGE_SIZE,
    min_sim: float = settings.MIN_SIMILARITY,
    decimals: int | None = None,
) -> DataFrame:
    """The whole lists of ``similar_products`` in the pages of ``ranking.pack_pages``: ``product1, page, recs``.

    A profile's list, its members included, is ranked once.  A member's is the same without itself:
    from its own place on, a page begins one rank later, so pages of profiles hold one entry more.
    With ``decimals`` scores are rounded before they are ranked.
    """
    profiles = Profiles(words)
    pairs = shared.stage(profile_similarity(profiles.weights, min_sim), "pairs")
    members = shared.stage(profiles.members.where(F.col("productId").isNotNull()), "members")
    score = F.col("score") if decimals is None else F.round("score", decimals)
    lists = (
        _with_self(pairs, profiles)
        .join(members.select(F.col("profileId").alias("profile2"), F.col("productId").alias("product2")), "profile2")
        .select("profile1", "product2", score.alias("score"))
    )
    ranked = shared.stage(ranking.list_rank(lists, "profile1", item="product2"), "ranked")
    page = F.floor((F.col("rank") - 1) / page_size).cast("int")
    also = (F.col("rank") > 1) & ((F.col("rank") - 1) % page_size == 0)
    entry = F.struct("rank", F.col("product2").alias("productId"), "score")
    pages = (
        ranked.withColumn("page", F.explode(F.when(also, F.array(page - 1, page)).otherwise(F.array(page))))
        .groupBy("profile1", "page")
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    )
    # An id of several rows has each entry once for each, and maybe several profiles.
    rows = members.groupBy("productId").agg(F.count(F.lit(1)).alias("rows"))
    repeated = shared.stage(rows.where("rows > 1").select("productId"), "repeated")
    single = members.join(repeated, "productId", "left_anti").select(
        F.col("profileId").alias("profile1"), F.col("productId").alias("product2")
    )
    own = ranked.join(single, ["profile1", "product2"]).select(
        "profile1", F.col("product2").alias("product1"), F.col("rank").alias("own")
    )
    others = F.filter("entries", lambda e: e["productId"] != F.col("product1"))
    begin = F.when(F.col("own") <= F.col("page") * page_size, 2).otherwise(1)
    found = (
        pages.join(own, "profile1")
        .withColumn("entries", F.slice(others, begin, page_size))
        .where(F.size("entries") > 0)
        .select(
            "product1",
            "page",
            F.transform(
                "entries", lambda e: F.struct(e["productId"].alias("productId"), e["score"].alias("score"))
            ).alias("recs"),
        )
    )
    if repeated.isEmpty():
        return found
    more = expand(profiles, pairs, repeated).withColumn("score", score)
    return found.unionByName(ranking.pack_pages(more, "product1", item="product2", page_size=page_size))


def top_similar(
    words: DataFrame | Profiles,
    k: int,
    min_sim: float = settings.MIN_SIMILARITY,
    requests: DataFrame | None = None,
) -> DataFrame:
    """``(productId, rank, recId, score)``: the best ``k`` of every list, or of those asked for.

    A profile's best ``k + 1`` products are found once and handed to all its members,
    each of which drops itself.
    """
    profiles = words if isinstance(words, Profiles) else Profiles(words)
    wanted = profiles.of(requests)
    pairs = _with_self(profile_similarity(profiles.weights, min_sim, wanted=wanted), profiles)
    members = profiles.members
    if wanted is not None:
        pairs = pairs.join(wanted.withColumnRenamed("profileId", "profile1"), "profile1", "left_semi")
        members = members.join(requests.select("productId"), "productId", "left_semi")
    # Each of the best k + 1 profiles, in (score, smallest id) order, brings at least one
    # product, and the members of a profile tie: k + 1 profiles with their k + 1 smallest
    # ids hold the best k + 1 products.
    by_score = F.desc(F.round("score", 9))
    nearest = ranking.top_per_key(pairs, "profile1", [by_score, F.asc("profile2")], k + 1, "place")
    leaders = ranking.top_per_key(
        profiles.members, "profileId", [F.asc("productId")], k + 1, "place"
    ).select(F.col("profileId").alias("profile2"), F.col("productId").alias("recId"))
    order = [by_score, F.asc("recId")]
    lists = ranking.top_per_key(
        nearest.drop("place").join(leaders, "profile2"), "profile1", order, k + 1, "place"
    )
    return ranking.top_per_key(
        lists.withColumnRenamed("profile1", "profileId")
        .join(members, "profileId")
        .where(F.col("recId") != F.col("productId"))
        .select("productId", "recId", "score"),
        "productId",
        order,
        k,
    ).select("productId", "rank", "recId", "score")


def pair_scores(profiles: Profiles, pairs: DataFrame) -> DataFrame:
    """``(product1, product2, score)``: the cosine of given pairs, those of cosine 0 left out."""
    members, weights = profiles.members, profiles.weights
    placed = pairs.select("product1", "product2").where("product1 <> product2").distinct()
    for side in ("1", "2"):
        own = members.select(
            F.col("productId").alias(f"product{side}"), F.col("profileId").alias(f"profile{side}")
        )
        placed = placed.join(own, f"product{side}")
    placed = shared.stage(placed, "pairs")
    norms = weights.groupBy("profileId").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    units = weights.join(norms, "profileId").select(
        "profileId", "term", (F.col("weight") / F.col("norm")).alias("unit")
    )
    left, right = (
        units.select(F.col("profileId").alias(f"profile{s}"), "term", F.col("unit").alias(f"unit{s}"))
        for s in ("1", "2")
    )
    cosines = (
        placed.select("profile1", "profile2")
        .distinct()
        .join(left, "profile1")
        .join(right, ["profile2", "term"])
        .groupBy("profile1", "profile2")
        .agg(F.sum(F.col("unit1") * F.col("unit2")).alias("score"))
        .withColumn("score", F.when(F.col("profile1") == F.col("profile2"), 1.0).otherwise(F.col("score")))
    )
    return placed.join(cosines, ["profile1", "profile2"]).select("product1", "product2", "score")
