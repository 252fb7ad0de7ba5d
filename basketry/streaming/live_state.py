"""What the live path knows of a user, as keyed state: the recent-rating queue and the rated products.

Users are dealt to a fixed number of shards, for a group of a stateful query costs more than a key
of a map.  A shard's maps have a user's queue and the user's rated products in pages.  The pages
are filled once from the rating table as the query's initial state and kept up by the events
themselves: a batch reads the state of the users it touches and no base table, and writes a user's
last page only.
"""

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from basketry import settings, shared
from basketry.streaming import recent_queue
from basketry.streaming.recent_queue import ENTRIES, EVENT_COLUMNS, OUTPUT

shared.ship(__name__)
shared.ship(recent_queue.__name__)

#: Rated products of a user in one page of the map.
PAGE = 1000
_OUTPUT = Row("userId", "rank", "productId", "score", "order1", "order2")


def _thin_out(size: int):
    """Of every chunk and user the newest ``size`` events, and one event of every product."""

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            ordered = rows.sort_values(["order1", "order2"], ascending=False)
            newest = ordered.groupby("userId", sort=False).cumcount() < size
            yield ordered[newest | ~ordered.duplicated(["userId", "productId"])]

    return thin


class LiveProcessor(StatefulProcessor):
    """Of the users of one shard: the queue, and below it the rated products, as rows without a rank."""

    def __init__(self, size: int):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.queues = handle.getMapState("queues", "userId bigint", ENTRIES)
        self.rated = handle.getMapState("rated", "userId bigint, page int", "products array<bigint>")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.rated.updateValue((initialState.userId, initialState.page), (initialState.products,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest: dict[int, list] = {}
        products: dict[int, dict[int, None]] = {}
        for row in rows:
            products.setdefault(row.userId, {})[row.productId] = None
            own = newest.setdefault(row.userId, [])
            own.append((row.order1, row.order2, row.productId, row.score))
            if len(own) > 8 * self.size:
                newest[row.userId] = sorted(own, reverse=True)[: self.size]
        for user, own in newest.items():
            if self.queues.containsKey((user,)):
                own += [tuple(e) for e in self.queues.getValue((user,))[0]]
            held = sorted(own, reverse=True)[: self.size]
            self.queues.updateValue((user,), (held,))
            for i, (order1, order2, product, score) in enumerate(held):
                yield _OUTPUT(user, i + 1, product, score, order1, order2)
            for page in self._rate(user, products.pop(user)):
                for product in page:
                    yield _OUTPUT(user, None, product, None, None, None)

    def _rate(self, user: int, products: Iterable[int]) -> list[list[int]]:
        """All pages of a user, after the products that aren't in them were added to the last."""
        pages: list[list[int]] = []
        while self.rated.containsKey((user, len(pages))):
            pages.append(list(self.rated.getValue((user, len(pages)))[0]))
        known = {p for page in pages for p in page}
        new = [p for p in products if p not in known]
        while new:
            if not pages or len(pages[-1]) >= PAGE:
                pages.append([])
            room = PAGE - len(pages[-1])
            pages[-1] += new[:room]
            new = new[room:]
            self.rated.updateValue((user, len(pages) - 1), (pages[-1],))
        return pages

    def close(self) -> None:
        pass


def _shard() -> Column:
    return F.pmod(F.xxhash64("userId"), F.lit(settings.LIVE_SHARDS)).cast("int").alias("shard")


def _pages(rated: DataFrame) -> DataFrame:
    """``userId, page, products`` of distinct (userId, productId), in pages of bounded length."""
    place = F.row_number().over(Window.partitionBy("userId").orderBy("productId"))
    paged = rated.withColumn("page", F.floor((place - 1) / PAGE).cast("int"))
    return paged.groupBy("userId", "page").agg(F.collect_list("productId").alias("products"))


def live_stream(events: DataFrame, rated: DataFrame, size: int = settings.QUEUE_SIZE) -> DataFrame:
    """Per batch, of every user it touches: the queue, ranked from 1, and all rated products, unranked.

    ``rated`` (userId, productId) counts at the first batch of a checkpoint only.
    """
    # State of one user needs keys of one type from both sides.
    ids = {c: F.col(c).cast("bigint") for c in ("userId", "productId")}
    columns = events.select(*EVENT_COLUMNS).withColumns(ids)
    known = rated.select("userId", "productId").withColumns(ids).distinct()
    return (
        columns.mapInPandas(_thin_out(size), columns.schema)
        .withColumn("shard", _shard())
        .groupBy("shard")
        .transformWithState(
            LiveProcessor(size), OUTPUT, "update", "none", initialState=_pages(known).withColumn("shard", _shard()).groupBy("shard")
        )
    )


def queue_in_state(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """``(userId, rank, productId, score)`` read from a query's checkpoint, of its last or a given batch.

    It serves the queue without a second copy of it; the query that keeps it may go on meanwhile.
    """
    reader = spark.read.format("statestore").option("stateVarName", "queue")
    if batch is not None:
        reader = reader.option("batchId", batch)
    with recent_queue.keyed_state(spark):
        held = reader.load(checkpoint).select(
            F.col("key.userId").alias("userId"), F.posexplode("value.entries").alias("place", "entry")
        )
        return held.select("userId", (F.col("place") + 1).alias("rank"), "entry.productId", "entry.score")


def rated_in_state(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """``(userId, productId)`` of all rated products that a live query holds."""
    reader = spark.read.format("statestore").option("stateVarName", "rated")
    if batch is not None:
        reader = reader.option("batchId", batch)
    with recent_queue.keyed_state(spark):
        return reader.load(checkpoint).select(
            F.col("user_map_key.userId").alias("userId"), F.explode("user_map_value.products").alias("productId")
        )
