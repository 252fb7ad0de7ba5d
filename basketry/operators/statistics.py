"""Popularity statistics over the rating table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import scalars


def rate_more_products(ratings: DataFrame) -> DataFrame:
    counts = ratings.groupBy("productId").agg(F.count("productId").alias("count"))
    return counts.orderBy(F.desc("count"), "productId")


def ratings_by_month(ratings: DataFrame, zone: str = "UTC") -> DataFrame:
    return ratings.select(
        "productId", "score", scalars.change_date("timestamp", zone).alias("yearmonth")
    )


def rate_more_recently(ratings: DataFrame, zone: str = "UTC") -> DataFrame:
    counts = (
        ratings_by_month(ratings, zone)
        .groupBy("productId", "yearmonth")
        .agg(F.count("productId").alias("count"))
    )
    return counts.orderBy(F.desc("yearmonth"), F.desc("count"), "productId")


def average_products(ratings: DataFrame) -> DataFrame:
    averages = ratings.groupBy("productId").agg(F.avg(F.col("score").cast("double")).alias("avg"))
    return averages.orderBy(F.desc("avg"), "productId")


def monthly_profile(ratings: DataFrame, zone: str = "UTC") -> DataFrame:
    """Counts and score sums per product and month.

    The only pass over the ratings that the three statistics tables need: counts
    and averages per product follow from it without reading a rating again.
    """
    return (
        ratings_by_month(ratings, zone)
        .groupBy("productId", "yearmonth")
        .agg(F.count("productId").alias("count"), F.sum("score").alias("score_sum"))
    )


def tables_from_monthly(monthly: DataFrame) -> dict[str, DataFrame]:
    per_product = monthly.groupBy("productId").agg(
        F.sum("count").alias("count"), F.sum("score_sum").alias("score_sum")
    )
    return {
        "count": per_product.select("productId", "count"),
        "recent": monthly.select("productId", "count", "yearmonth"),
        "average": per_product.select(
            "productId", (F.col("score_sum") / F.col("count")).alias("avg")
        ),
    }


def statistics_in_one_scan(ratings: DataFrame, zone: str = "UTC") -> DataFrame:
    """Monthly count, total count and average of every product in one result.

    A product's months are bounded by the calendar, so they travel as one array and the
    ratings are read and shuffled once.
    """
    return all_from_monthly(monthly_profile(ratings, zone))


def all_from_monthly(monthly: DataFrame) -> DataFrame:
    """As ``statistics_in_one_scan``, from the profile."""
    months = F.collect_list(F.struct("yearmonth", F.col("count").alias("month_count")))
    return (
        monthly.groupBy("productId")
        .agg(
            F.sum("count").alias("total_count"),
            (F.sum("score_sum") / F.sum("count")).alias("avg"),
            months.alias("months"),
        )
        .select("productId", "total_count", "avg", F.inline("months"))
    )


def hot(recent: DataFrame, n: int) -> DataFrame:
    """Latest month first, then the most rated in it."""
    return recent.orderBy(F.desc("yearmonth"), F.desc("count"), "productId").limit(n)


def most_rated(counts: DataFrame, n: int) -> DataFrame:
    return counts.orderBy(F.desc("count"), "productId").limit(n)


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("userId").distinct()


def distinct_products(ratings: DataFrame) -> DataFrame:
    return ratings.select("productId").distinct()


def count_by(people: DataFrame, *keys: str) -> DataFrame:
    return people.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
