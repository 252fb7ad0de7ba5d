"""Live recommendations: rating events in, one replaced list per user out."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import settings, shared
from basketry.operators import online, ranking
from basketry.sinks.tables import batches, fold_batches, write_batch
from basketry.streaming import run
from basketry.streaming.live_state import live_stream
from basketry.streaming.recent_queue import EVENT_COLUMNS, keyed_state

RATING_UPDATES = "RatingUpdates"
_UPDATES_SCHEMA = "userId bigint, order1 bigint, order2 bigint, productId bigint, score double"
_RECS_SCHEMA = "userId bigint, recs array<struct<productId:bigint,score:double>>, batch int"


class OnlineRecommender:
    """Two queries over the same events (userId, productId, score, order1, order2).

    ``start_updates`` writes the events of batch ``n`` to ``RatingUpdates/batch=n``, map-only;
    ``jobs.merge_updates_job`` merges and removes them.  ``start`` keeps
    queues and rated products as keyed state, joins and scores in ``foreachBatch`` and writes the
    lists of batch ``n`` to ``StreamRecs/batch=n``; a repeated batch replaces its folder, and no
    batch rewrites what earlier ones wrote; now and then old folders are folded into one.
    Tables staged for a batch are removed at its end.

    ``load_rated`` gives the rated products that the state of a new checkpoint starts with; after
    that a product counts as rated when an event says so, and no batch reads the rating table.
    ``load_similarity`` is called in every batch, so a refreshed similarity table is seen at once.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        load_similarity: Callable[[], DataFrame | online.Similarity],
        load_rated: Callable[[], DataFrame],
        fold_every: int = settings.FOLD_EVERY,
    ):
        self.spark, self.root, self.fold_every = spark, root, fold_every
        self.load_similarity, self.load_rated = load_similarity, load_rated

    def start_updates(self, events: DataFrame, checkpoint: str, once: bool = False):
        def write(rows: DataFrame, batch_id: int) -> None:
            write_batch(rows, self.root, RATING_UPDATES, batch_id)

        writer = events.select(*EVENT_COLUMNS).writeStream.outputMode("append").foreachBatch(write)
        return run.start(writer, checkpoint, once)

    def start(self, events: DataFrame, checkpoint: str, once: bool = False):
        live = live_stream(events, self.load_rated())
        writer = live.writeStream.outputMode("update").foreachBatch(self.process)
        with keyed_state(self.spark):
            return run.start(writer, checkpoint, once)

    def process(self, state_rows: DataFrame, batch_id: int) -> None:
        """Lists of the users of a batch, from their queues (ranked rows) and rated products (all rows)."""
        with shared.scratch(self.spark):
            state = shared.stage(state_rows, "state")
            triggers = state.where(F.col("rank") == 1).select("userId", "productId")
            recents = state.where(F.col("rank") <= settings.N_RECENT)
            rated = state.select("userId", "productId")
            recs = online.recommend(triggers, recents, rated, self.load_similarity())
            write_batch(recs, self.root, settings.STREAM_RECS, batch_id)
        if batch_id % self.fold_every == 0:
            fold_batches(self.spark, self.root, settings.STREAM_RECS, "userId", _RECS_SCHEMA)

    def rating_updates(self) -> DataFrame:
        """Events that aren't merged into the rating table yet."""
        return read_updates(self.spark, self.root)

    def current_recs(self) -> DataFrame:
        return current_recs(self.spark, self.root)

    def current_rows(self) -> DataFrame:
        return current_rows(self.spark, self.root)


def current_recs(spark: SparkSession, root: str) -> DataFrame:
    """The newest list of every user."""
    lists = spark.read.schema(_RECS_SCHEMA).parquet(f"{root}/{settings.STREAM_RECS}")
    return lists.groupBy("userId").agg(F.max_by("recs", "batch").alias("recs"))


def current_rows(spark: SparkSession, root: str) -> DataFrame:
    return ranking.unpack_recs(current_recs(spark, root), "userId")


def read_updates(spark: SparkSession, root: str) -> DataFrame:
    """``RatingUpdates`` under ``root``; no rows before the first batch wrote them."""
    if not batches(spark, root, RATING_UPDATES):
        return spark.createDataFrame([], _UPDATES_SCHEMA)
    return spark.read.schema(_UPDATES_SCHEMA).parquet(f"{root}/{RATING_UPDATES}")
