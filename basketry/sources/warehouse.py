"""The order warehouse seen as products, ratings, rating events and log lines."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import scalars


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        orders.o_custkey.cast("bigint").alias("userId"),
        lines.l_partkey.cast("bigint").alias("productId"),
        (1 + lines.l_quantity.cast("int") % 5).cast("double").alias("score"),
        scalars.epoch_seconds(lines.l_shipdate).alias("timestamp"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").cast("bigint").alias("productId"),
        F.col("p_name").alias("name"),
        F.lit("").alias("imageUrl"),
        F.col("p_type").alias("categories"),
        F.concat_ws("|", F.translate("p_name", " ", "|"), "p_type", "p_brand").alias("tags"),
    )


def events_as_ratings(events: DataFrame) -> DataFrame:
    """Batch or streaming ``events`` as rating events with their order key."""
    return events.select(
        F.col("user_id").cast("bigint").alias("userId"),
        F.get_json_object("props", "$.k").cast("bigint").alias("productId"),
        (1 + F.col("event_id") % 5).cast("double").alias("score"),
        scalars.epoch_seconds("ts").alias("timestamp"),
        "ts",
        "event_id",
        "event_type",
    )


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_ratings(table(spark, sf_dir, "events")).drop("event_type")


def events_as_log_lines(events: DataFrame) -> DataFrame:
    """One log line per event: a rating line, or noise for errors and sign-ups."""
    line = scalars.log_line("userId", "productId", "score", "timestamp")
    return events_as_ratings(events).select(
        "event_id",
        F.when(
            F.col("event_type").isin("error", "signup"), F.concat(F.lit("app "), "event_type")
        )
        .otherwise(F.concat(F.lit("INFO "), line, F.lit(" ")))
        .alias("value"),
    )


def dense_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").alias("features")
    )
