"""Streaming sources.  Every one has a text column ``value`` or declared columns."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import settings


def kafka_events(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Rating events from Kafka, from the latest offset; needs the Kafka connector."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .options(**options)
        .load()
        .selectExpr("CAST(value AS STRING) AS value")
    )


def log_tail(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Lines appended to a folder of log files that mention a product rating."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(folder)
    return lines.where(lines.value.rlike(settings.LOG_LINE_PATTERN))


def rotated_log(
    spark: SparkSession,
    folder: str,
    pattern: str,
    archive: str | None = None,
    max_age: str = settings.LOG_MAX_AGE,
    max_files: int | None = None,
) -> DataFrame:
    """Lines of log files that were rotated out, as ``value`` and ``complete``.

    ``pattern`` matches rotated files only (``agent.log.*``), not the one still written; their
    names, by date or a growing number, mustn't come again.  A last line without a line end was
    cut off by a crash: it isn't ``complete`` and belongs to a dead-letter table, as it may still
    look like an event.  A file is one row before it is cut, so the size at which the logger
    rotates bounds a task.  Read files move to ``archive``, outside ``folder``, once the batch after theirs
    begins; files older than the newest by ``max_age`` when they turn up are left alone, and the
    checkpoint forgets names of that age.
    """
    reader = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", pattern)
        .option("maxFileAge", max_age)
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = F.split("value", "\r?\n", -1)
    cut = F.concat(
        F.transform(F.slice(lines, 1, F.size(lines) - 1), lambda x: F.struct(x.alias("value"), F.lit(True).alias("complete"))),
        F.array(F.struct(F.element_at(lines, -1).alias("value"), F.lit(False).alias("complete"))),
    )
    found = reader.load(folder).select(F.inline(cut))
    return found.where("complete OR value <> ''")


def table_stream(
    spark: SparkSession, path: str, max_files: int | None = None, schema=None
) -> DataFrame:
    """The rows of a stored table as a stream, whether it is one file or a folder of part files.

    A file source takes a folder or a glob, so the table is named by a glob that only its own
    path matches.  A table that isn't there fails here rather than giving an empty stream.
    """
    if schema is None:
        schema = spark.read.parquet(path).schema
    path = path.rstrip("/")
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def parquet_stream(
    spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", max_files=None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)
