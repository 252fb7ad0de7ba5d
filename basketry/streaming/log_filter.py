"""Log lines to rating events: keep, cut out the payload, parse.  Map-only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import settings
from basketry.functions import scalars
from basketry.sinks.tables import batches, write_batch
from basketry.streaming import run


def keep_rating_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("value").contains(settings.LOG_PREFIX))


def payload(line="value"):
    """Text between the first prefix and the next one, if there is one, trimmed."""
    return F.trim(F.split(line, settings.LOG_PREFIX)[1])


def extract_payloads(lines: DataFrame) -> DataFrame:
    return keep_rating_lines(lines).withColumn("value", payload())


def parse_events(
    payloads: DataFrame, permissive: bool = False, time_unit: str = "s"
) -> DataFrame:
    """``userId|productId|score|timestamp`` to typed columns.

    A malformed event fails the job; in permissive mode its columns are null and the text
    stays in ``value`` for a dead-letter table.
    """
    parts = F.split("value", "[|]")

    def field(i, kind):
        part = F.get(parts, F.lit(i)) if permissive else parts[i]
        return part.try_cast(kind) if permissive else part.cast(kind)

    typed = payloads.select(
        *[c for c in payloads.columns if permissive or c != "value"],
        field(0, "bigint").alias("userId"),
        field(1, "bigint").alias("productId"),
        field(2, "double").alias("score"),
        scalars.normalise_epoch(field(3, "bigint"), time_unit).alias("timestamp"),
    )
    return typed


def _malformed():
    return (
        F.col("userId").isNull()
        | F.col("productId").isNull()
        | F.col("score").isNull()
        | F.col("timestamp").isNull()
    )


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(_malformed()).select("value")


def start_filter(lines: DataFrame, sink: dict, checkpoint: str, once: bool = False):
    """Run the filter as a query into ``sink`` = {"format": ..., **options}."""
    writer = (
        extract_payloads(lines)
        .select("value")
        .writeStream.format(sink["format"])
        .options(**{k: v for k, v in sink.items() if k != "format"})
        .outputMode("append")
    )
    return run.start(writer, checkpoint, once)


def start_tail(lines: DataFrame, root: str, checkpoint: str, once: bool = False, time_unit: str = "s"):
    """Events of ``streams.rotated_log`` into ``LoggedEvents`` under ``root``, bad lines beside them.

    A line cut off by the end of its file and a line that can't be parsed go to
    ``HalfWrittenLines`` as they are.  Each batch is a partition of both tables that a repeated
    batch replaces, so every line of every file is in one of them once, or is no rating line.
    """

    def write(batch: DataFrame, number: int) -> None:
        kept = keep_rating_lines(batch)
        parsed = parse_events(
            kept.select(F.col("value").alias("line"), "complete", payload().alias("value")),
            permissive=True,
            time_unit=time_unit,
        )
        good = F.col("complete") & ~_malformed()
        write_batch(
            parsed.where(good).select("userId", "productId", "score", "timestamp"),
            root,
            settings.LOGGED_EVENTS,
            number,
        )
        write_batch(parsed.where(~good).select("line"), root, settings.HALF_LINES, number)

    return run.start(lines.writeStream.foreachBatch(write), checkpoint, once)


def logged(spark, root: str, name: str = settings.LOGGED_EVENTS) -> DataFrame:
    """What ``start_tail`` has written to a table so far, with the ``batch``."""
    columns = {
        settings.LOGGED_EVENTS: "userId bigint, productId bigint, score double, timestamp bigint, batch int",
        settings.HALF_LINES: "line string, batch int",
    }[name]
    if not batches(spark, root, name):
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).parquet(f"{root}/{name}")
