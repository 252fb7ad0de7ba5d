import random
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from basketry import settings, shared
from basketry.operators import online, ratings
from basketry.sinks import tables
from basketry.sources import streams
from basketry.streaming import live_state, log_filter, recent_queue
from basketry.streaming.online import OnlineRecommender

EVENTS = "userId int, productId int, score double, order1 bigint, order2 bigint"


def test_log_tail_filter_and_parse(spark, tmp_path, rows):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "a.log").write_text(
        "x PRODUCT_RATING_PREFIX:1|2|3.5|1564754545 \nnoise\nx PRODUCT_RATING_PREFIX 1|2\n"
    )
    (logs / "b.log").write_text(
        "y PRODUCT_RATING_PREFIX:7|8|1.0|1564754546 PRODUCT_RATING_PREFIX:9|9|9|9\n"
    )
    sink = {"format": "parquet", "path": str(tmp_path / "product")}

    def run():
        query = log_filter.start_filter(
            streams.log_tail(spark, str(logs), 1), sink, str(tmp_path / "checkpoint"), once=True
        )
        query.awaitTermination()
        return rows(log_filter.parse_events(spark.read.parquet(sink["path"])))

    first = [(1, 2, 3.5, 1564754545), (7, 8, 1.0, 1564754546)]
    assert run() == first
    # A restart goes on from the checkpoint.
    (logs / "c.log").write_text("z PRODUCT_RATING_PREFIX:4|5|2.0|1564754547\n")
    assert run() == sorted([*first, (4, 5, 2.0, 1564754547)])


def test_log_tail_over_rotation(spark, tmp_path, rows):
    logs, root = tmp_path / "logs", str(tmp_path / "tables")
    archive = tmp_path / "archive"
    logs.mkdir()
    line = "x PRODUCT_RATING_PREFIX:{}|2|3.5|1564754545"
    (logs / "agent.log").write_text(line.format(99) + "\n")  # still written
    (logs / "agent.log.1").write_text(line.format(1) + "\r\nnoise\n" + line.format(2) + "\n")
    # Cut off in the time of its last event, which still reads as a number.
    (logs / "agent.log.2").write_text(line.format(3) + "\n" + line.format(4)[:-3])
    (logs / "agent.log.3").write_text("")

    def run():
        tail = streams.rotated_log(spark, str(logs), "agent.log.*", str(archive), max_files=1)
        log_filter.start_tail(tail, root, str(tmp_path / "checkpoint"), once=True).awaitTermination()
        return rows(log_filter.logged(spark, root), "userId", "timestamp")

    first = [(1, 1564754545), (2, 1564754545), (3, 1564754545)]
    assert run() == first
    # Rotation goes on while the query is down; a malformed line is kept beside the events.
    (logs / "agent.log").rename(logs / "agent.log.4")
    (logs / "agent.log").write_text("")
    (logs / "agent.log.5").write_text("x PRODUCT_RATING_PREFIX:7|x|1.0|1\n")
    for _ in range(2):
        assert run() == [*first, (99, 1564754545)]
    bad = log_filter.logged(spark, root, settings.HALF_LINES)
    assert rows(bad, "line") == [("x PRODUCT_RATING_PREFIX:4|2|3.5|1564754",), ("x PRODUCT_RATING_PREFIX:7|x|1.0|1",)]
    moved = {p.name for p in archive.rglob("agent.log.*")}
    assert {"agent.log.1", "agent.log.2"} <= moved
    assert not moved & {p.name for p in logs.iterdir()}


def test_no_log_yet(spark, tmp_path, rows):
    (tmp_path / "logs").mkdir()
    tail = streams.rotated_log(spark, str(tmp_path / "logs"), "agent.log.*")
    log_filter.start_tail(tail, str(tmp_path / "t"), str(tmp_path / "c"), once=True).awaitTermination()
    assert rows(log_filter.logged(spark, str(tmp_path / "t"))) == []


def test_malformed_events(spark, rows):
    df = spark.createDataFrame([("1|2|3.5|100",), ("1|x|3.5|100",), ("1|2",)], "value string")
    with pytest.raises(Exception):
        log_filter.parse_events(df).collect()
    parsed = log_filter.parse_events(df, permissive=True)
    assert rows(log_filter.dead_letters(parsed)) == [("1|2",), ("1|x|3.5|100",)]


def event_batches():
    rng = random.Random(2)
    events = [
        (0 if rng.random() < 0.4 else rng.randrange(1, 6), rng.randrange(30), float(rng.randrange(1, 6)), 1000 + i // 3, i)
        for i in range(400)
    ]
    rng.shuffle(events)  # late events among them
    return [events[i : i + 100] for i in range(0, 400, 100)]


@pytest.fixture
def event_folder(spark, tmp_path):
    folder = tmp_path / "events"

    def add(batch):
        spark.createDataFrame(batch, EVENTS).coalesce(1).write.mode("append").parquet(str(folder))

    return str(folder), add


def event_stream(spark, folder):
    return streams.parquet_stream(
        spark, folder, spark.createDataFrame([], EVENTS).schema, max_files=1
    )


def test_queue_state_over_batches_and_a_restart(spark, tmp_path, rows, event_folder):
    folder, add = event_folder
    batches = event_batches()
    columns = ("userId", "rank", "productId", "score")
    seen = []
    for pair in (batches[:2], batches[2:]):
        for batch in pair:
            add(batch)
            seen += batch
        recent_queue.start_queue(
            event_stream(spark, folder), str(tmp_path / "out"), str(tmp_path / "cp"), once=True
        ).awaitTermination()
        expected = ratings.recent_queue(
            spark.createDataFrame(seen, EVENTS), ("order1", "order2")
        )
        assert spark.conf.get(recent_queue._PROVIDER) != recent_queue._ROCKSDB
        found = recent_queue.current_queue(spark, str(tmp_path / "out"))
        assert rows(found, *columns) == rows(expected, *columns)


def test_online_recommender_over_batches(spark, tmp_path, event_folder):
    folder, add = event_folder
    rng = random.Random(4)
    scores = {}
    for p in range(30):
        for q in range(p):
            scores[p, q] = scores[q, p] = round(0.3 + 0.7 * rng.random(), 3)
    sim = spark.createDataFrame(
        [(p, q, s) for (p, q), s in scores.items()], "product1 int, product2 int, score double"
    )
    base = spark.createDataFrame([(u, u + 1) for u in range(6)], "userId int, productId int")
    recommender = OnlineRecommender(spark, str(tmp_path / "out"), lambda: sim, lambda: base)
    seen = []
    for batch in event_batches()[:2]:
        batch = batch[:40]
        add(batch)
        seen += batch
        for run, name in ((recommender.start_updates, "updates"), (recommender.start, "cp")):
            run(event_stream(spark, folder), str(tmp_path / name), once=True).awaitTermination()

    events = spark.createDataFrame(seen, EVENTS)
    assert recommender.rating_updates().count() == len(seen)
    # Users of the last batch: scored on everything seen so far.
    last_users = spark.createDataFrame([(u,) for u in {e[0] for e in batch}], "userId int")
    order = ("order1", "order2")
    triggers = online.latest_event(events, order).join(last_users, "userId", "left_semi")
    recents = ratings.recent_queue(events, order, 21)
    rated = base.unionByName(events.select("userId", "productId"))
    expected = online.recommend(triggers.select("userId", "productId"), recents, rated, sim)

    def lists(df):
        return {
            r["userId"]: [(x["productId"], round(x["score"], 9)) for x in r["recs"]] for r in df.collect()
        }

    found = lists(recommender.current_recs())
    for user, recs in lists(expected).items():
        assert found[user] == recs


def test_a_repeated_batch_changes_nothing(spark, tmp_path, rows):
    """Also without any updates: what is in the queue counts as rated."""
    sim = spark.createDataFrame(
        [(1, 2, 0.9), (2, 1, 0.9), (1, 3, 0.8), (3, 1, 0.8)],
        "product1 int, product2 int, score double",
    )
    base = spark.createDataFrame([], "userId int, productId int")
    recommender = OnlineRecommender(spark, str(tmp_path / "out"), lambda: sim, lambda: base)
    batch = spark.createDataFrame(
        [(5, 1, 1, 4.0, 10, 2), (5, 2, 3, 2.0, 10, 1)], recent_queue.OUTPUT
    )
    for _ in range(2):
        recommender.process(batch, 0)
        assert rows(recommender.current_rows()) == [(5, 1, 2, pytest.approx(3.6))]


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(Exception):
        streams.kafka_events(spark, "broker:9092", "ratings")


@pytest.mark.parametrize("parts", [1, 4])
def test_table_stream_reads_files_and_folders(spark, tmp_path, rows, parts):
    """One parquet file, and a folder of part files, of the same name beside other tables."""
    df = spark.createDataFrame([(i, f"x{i}") for i in range(20)], "id int, name string")
    if parts == 1:
        df.toPandas().to_parquet(tmp_path / "events.parquet")
        df.toPandas().to_parquet(tmp_path / "events.parquex")
    else:
        df.repartition(parts).write.parquet(str(tmp_path / "events.parquet"))
        df.write.parquet(str(tmp_path / "events.parquex"))
    stream = streams.table_stream(spark, str(tmp_path / "events.parquet"))
    sink = {"path": str(tmp_path / "out"), "checkpointLocation": str(tmp_path / "cp")}
    query = stream.writeStream.format("parquet").options(**sink).trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.read.parquet(sink["path"]), "id", "name") == rows(df)


def test_table_stream_of_a_missing_table_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        streams.table_stream(spark, str(tmp_path / "nothing.parquet"))


def test_folding_keeps_the_newest_rows_and_bounds_the_folders(spark, tmp_path):
    rng = random.Random(7)
    schema, root = "userId int, rank int, score double, batch int", str(tmp_path)
    state = {}
    for batch in range(50):
        users = rng.sample(range(12), 3)
        fresh = {u: [(u, r, float(batch)) for r in range(1, 1 + rng.randrange(1, 4))] for u in users}
        state |= fresh
        rows = spark.createDataFrame(sum(fresh.values(), []), "userId int, rank int, score double")
        tables.write_batch(rows.coalesce(1), root, "T", batch)
        if batch % 10 == 0:
            for _ in range(1 + batch // 30):  # a repeated fold changes nothing
                tables.fold_batches(spark, root, "T", "userId", schema)
        assert len(tables.batches(spark, root, "T")) <= 12
    found = spark.read.schema(schema).parquet(f"{root}/T")
    last = found.groupBy("userId").agg(F.max("batch").alias("batch"))
    newest = found.join(last, ["userId", "batch"], "left_semi").drop("batch").collect()
    assert sorted(map(tuple, newest)) == sorted(sum(state.values(), []))


def test_batches_leave_no_staged_tables(spark, tmp_path):
    staged = Path(shared.shared_dir(spark).removeprefix("file://")) / "basketry"
    sim = spark.createDataFrame([(1, 2, 0.9), (2, 1, 0.9)], "product1 int, product2 int, score double")
    base = spark.createDataFrame([], "userId int, productId int")
    recommender = OnlineRecommender(spark, str(tmp_path / "out"), lambda: sim, lambda: base, fold_every=2)
    before = set(staged.glob("*")) if staged.exists() else set()
    for batch in range(6):
        rows = spark.createDataFrame([(batch % 3, 1, 1, 4.0, 10, 2)], recent_queue.OUTPUT)
        recommender.process(rows, batch)
    assert set(staged.glob("*")) == before
    assert len(tables.batches(spark, str(tmp_path / "out"), "StreamRecs")) <= 3
    assert {r["userId"] for r in recommender.current_rows().collect()} == {0, 1, 2}


def test_state_starts_from_the_table_and_batches_read_none(spark, tmp_path, event_folder):
    """Also over a restart, and with users and products that only the table has."""
    folder, add = event_folder
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    pairs = [(u, p) for u in range(4) for p in range(100, 100 + 40 * u)]
    base = spark.createDataFrame(pairs, "userId bigint, productId bigint")
    near = [(1, 2, 0.9), (1, 100, 0.8), (1, 7, 0.7)]
    sim = spark.createDataFrame(near + [(b, a, s) for a, b, s in near], "product1 int, product2 int, score double")
    recommender = OnlineRecommender(
        spark, str(tmp_path / "out"), lambda: sim, lambda: base.mapInPandas(counted, base.schema)
    )
    seen = set(pairs)
    for batch in ([(1, 1, 5.0, 1, 1), (3, 7, 4.0, 1, 2)], [(1, 1, 2.0, 2, 1)], [(1, 5, 5.0, 3, 1), (1, 1, 5.0, 4, 1)]):
        add(batch)
        seen |= {e[:2] for e in batch}
        recommender.start(event_stream(spark, folder), str(tmp_path / "cp"), once=True).awaitTermination()
        assert reads.value == len(pairs)
        held = [tuple(r) for r in live_state.rated_in_state(spark, str(tmp_path / "cp")).collect()]
        assert len(held) == len(set(held)) and set(held) == seen
        # 100 is rated by user 1 in the table only.
        recs = {r.userId: {x.productId for x in r.recs} for r in recommender.current_recs().collect()}
        assert recs[1] == {2, 7}


def test_pages_of_a_user_with_many_rated_products(spark, tmp_path, event_folder, monkeypatch):
    folder, add = event_folder
    base = spark.range(2 * live_state.PAGE + 5).selectExpr("1L AS userId", "id AS productId")
    out = []
    for batch in ([(1, 5_000, 1.0, 1, 1)], [(1, p, 1.0, 2, p) for p in range(6_000, 7_500)]):
        add(batch)
        writer = live_state.live_stream(event_stream(spark, folder), base).writeStream.outputMode("update")
        writer = writer.foreachBatch(lambda df, _: out.append(df.where("rank IS NULL").count()))
        with recent_queue.keyed_state(spark):
            writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert out == [2 * live_state.PAGE + 6, 2 * live_state.PAGE + 1506]


def test_queue_read_from_the_state_of_any_batch(spark, tmp_path, rows, event_folder):
    folder, add = event_folder
    columns = ("userId", "rank", "productId", "score")
    seen, expected = [], []
    for batch in event_batches()[:2]:
        add(batch)
        seen += batch
        expected.append(rows(ratings.recent_queue(spark.createDataFrame(seen, EVENTS), ("order1", "order2")), *columns))
    stream = recent_queue.queue_stream(event_stream(spark, folder))
    with recent_queue.keyed_state(spark):
        writer = stream.writeStream.outputMode("update").format("noop")
        writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    for number, queue in enumerate(expected):
        assert rows(live_state.queue_in_state(spark, str(tmp_path / "cp"), number), *columns) == queue
