"""Delimited text sources."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas, settings

_PRODUCT_FILE = T.StructType(
    [
        T.StructField("productId", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("categoryIds", T.StringType()),
        T.StructField("externalId", T.StringType()),
        T.StructField("imageUrl", T.StringType()),
        T.StructField("categories", T.StringType()),
        T.StructField("tags", T.StringType()),
    ]
)


def _delimited(spark, path, schema, separator) -> DataFrame:
    # Quotes are plain text in these files; a malformed row fails the read.
    return (
        spark.read.schema(schema)
        .option("sep", separator)
        .option("quote", "")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Seven caret-separated fields; category ids and the external id are dropped."""
    raw = _delimited(spark, path, _PRODUCT_FILE, settings.PRODUCT_SEPARATOR)
    text = ("name", "imageUrl", "categories", "tags")
    return raw.select("productId", *[F.coalesce(F.trim(c), F.lit("")).alias(c) for c in text])


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return _delimited(spark, path, schemas.RATING, settings.RATING_SEPARATOR)


def read_people(spark: SparkSession, path: str) -> DataFrame:
    return _delimited(spark, path, schemas.PERSON, settings.RATING_SEPARATOR)
