"""The recent-rating queue as keyed state of a streaming query."""

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from basketry import settings, shared
from basketry.sinks.tables import fold_batches, write_batch
from basketry.streaming import run

shared.ship(__name__)

EVENT_COLUMNS = ("userId", "order1", "order2", "productId", "score")
OUTPUT = "userId bigint, rank int, productId bigint, score double, order1 bigint, order2 bigint"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ENTRIES = "entries array<struct<order1:bigint,order2:bigint,productId:bigint,score:double>>"


def _newest(rows: pd.DataFrame, size: int) -> pd.DataFrame:
    ordered = rows.sort_values(["order1", "order2"], ascending=False)
    return ordered.groupby("userId", sort=False).head(size)


def _thin_out(size: int):
    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield _newest(rows, size)

    return thin


class QueueProcessor(StatefulProcessor):
    """At most ``size`` newest ratings per user, read chunk by chunk."""

    def __init__(self, size: int):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.queue = handle.getValueState("queue", ENTRIES)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        held = [tuple(e) for e in self.queue.get()[0]] if self.queue.exists() else []
        for chunk in rows:
            entries = _newest(chunk, self.size)[["order1", "order2", "productId", "score"]]
            held += list(entries.itertuples(index=False, name=None))
            held = sorted(held, reverse=True)[: self.size]
        self.queue.update((held,))
        yield pd.DataFrame(
            [(key[0], i + 1, p, s, a, b) for i, (a, b, p, s) in enumerate(held)],
            columns=["userId", "rank", "productId", "score", "order1", "order2"],
        )

    def close(self) -> None:
        pass


def queue_stream(events: DataFrame, size: int = settings.QUEUE_SIZE) -> DataFrame:
    """Per batch: the whole queue, ranked from 1, of every user the batch touches.

    ``events`` has ``EVENT_COLUMNS``; (order1, order2) orders a user's ratings.  Ahead of
    the shuffle every chunk of input rows keeps ``size`` events per user, so a user with a
    large share of the stream does not send all of it to one task.
    """
    columns = events.select(*EVENT_COLUMNS)
    return (
        columns.mapInPandas(_thin_out(size), columns.schema)
        .groupBy("userId")
        .transformWithStateInPandas(QueueProcessor(size), OUTPUT, "update", "none")
    )


@contextmanager
def keyed_state(spark: SparkSession):
    """Start a query with state inside: it keeps the settings it was started with.

    Other streams of the session go on with the state store they are set to.
    """
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


QUEUE = "RecentQueue"


def start_queue(
    events: DataFrame,
    root: str,
    checkpoint: str,
    once: bool = False,
    fold_every: int = settings.FOLD_EVERY,
):
    """Keep ``RecentQueue`` under ``root``: each batch writes the queues it changed."""

    def write(rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, root, QUEUE, batch_id)
        if batch_id % fold_every == 0:
            fold_batches(rows.sparkSession, root, QUEUE, "userId", OUTPUT + ", batch int")

    writer = queue_stream(events).writeStream.outputMode("update").foreachBatch(write)
    with keyed_state(events.sparkSession):
        return run.start(writer, checkpoint, once)


def current_queue(spark: SparkSession, root: str) -> DataFrame:
    """Every user's queue as of the last batch that touched the user."""
    rows = spark.read.schema(OUTPUT + ", batch int").parquet(f"{root}/{QUEUE}")
    last = rows.groupBy("userId").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["userId", "batch"], "left_semi").drop("batch")
