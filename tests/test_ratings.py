import pyarrow as pa
import pytest

from basketry import settings
from basketry.operators import ranking, ratings

SCHEMA = "userId int, productId int, score double, timestamp long"


def test_upsert_keeps_the_time_of_a_known_pair(spark, rows):
    base = spark.createDataFrame([(1, 10, 3.0, 100), (2, 10, 1.0, 50)], SCHEMA)
    updates = spark.createDataFrame([(1, 10, 4.5, 200), (1, 20, 2.0, 201)], SCHEMA)
    assert rows(ratings.upsert(base, updates)) == [
        (1, 10, 4.5, 100),
        (1, 20, 2.0, 201),
        (2, 10, 1.0, 50),
    ]


def test_upsert_takes_the_last_of_several_updates(spark, rows):
    base = spark.createDataFrame([], SCHEMA)
    updates = spark.createDataFrame([(1, 10, 1.0, 100), (1, 10, 5.0, 300), (1, 10, 2.0, 200)], SCHEMA)
    assert rows(ratings.upsert(base, updates)) == [(1, 10, 5.0, 100)]


def test_queue_keeps_the_newest_forty(spark):
    pushed = spark.createDataFrame([(7, i, 1.0, 1000 + i) for i in range(45)], SCHEMA)
    queue = ratings.recent_queue(pushed)
    found = [r["productId"] for r in queue.orderBy("rank").collect()]
    assert found == list(range(44, 4, -1))
    assert ratings.recent_ratings(queue).count() == settings.N_RECENT == 21


def test_queue_texts_round_trip(spark, rows):
    pushed = spark.createDataFrame([(7, i, i / 2, 1000 + i) for i in range(5)], SCHEMA)
    queue = ratings.recent_queue(pushed)
    items = ratings.queue_items(queue)
    assert items.first()["items"] == ["4:2.0", "3:1.5", "2:1.0", "1:0.5", "0:0.0"]
    columns = ("userId", "rank", "productId", "score")
    assert rows(ratings.parse_queue_items(items), *columns) == rows(queue, *columns)


def test_rate_updates_table_queue_and_log(spark, rows):
    base = spark.createDataFrame([(1, 10, 3.0, 100)], SCHEMA)
    queue = spark.createDataFrame([(1, 10, 3.0, 100)], SCHEMA)
    requests = spark.createDataFrame([(1, 10, 9.0, 200), (1, 20, 0.25, 201)], SCHEMA)
    result = ratings.rate(base, queue, requests)
    assert rows(result["ratings"]) == [(1, 10, 4.5, 100), (1, 20, 0.13, 201)]
    assert rows(result["queue"], "rank", "productId", "score") == [
        (1, 20, 0.13),
        (2, 10, 4.5),
        (3, 10, 3.0),
    ]
    assert rows(result["log"]) == [
        ("PRODUCT_RATING_PREFIX:1|10|4.5|200",),
        ("PRODUCT_RATING_PREFIX:1|20|0.13|201",),
    ]


def test_tags(spark, rows):
    tags = spark.createDataFrame(
        [(1, 5, "b"), (2, 5, "a"), (3, 5, "b"), (1, 6, "c")], "userId int, productId int, tag string"
    )
    assert rows(ratings.aggregate_tags(tags)) == [(5, "a|b"), (6, "c")]


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_list_rank_of_one_long_list(spark, coalesce):
    """One key holds nearly all rows and many of them tie; its list spans many ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    lists = spark.range(20000).selectExpr(
        "cast(if(id < 19000, 1, id % 50) as int) AS k",
        "cast(id AS int) AS productId",
        "cast(id % 7 as double) AS score",
    )
    try:
        found = ranking.list_rank(lists, "k").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    by_key = {}
    for r in found:
        by_key.setdefault(r["k"], []).append((r["rank"], -r["score"], r["productId"]))
    assert len(found) == 20000
    for entries in by_key.values():
        expected = sorted((s, p) for _, s, p in entries)
        assert sorted(entries) == [(i + 1, s, p) for i, (s, p) in enumerate(expected)]


def test_pages_hold_whole_lists_in_order(spark):
    lists = spark.createDataFrame(
        [(1, p, float(p % 10)) for p in range(25)], "k int, productId int, score double"
    )
    pages = ranking.pack_pages(lists, "k", page_size=10).orderBy("page").collect()
    assert [len(p["recs"]) for p in pages] == [10, 10, 5]
    found = [(r["score"], r["productId"]) for p in pages for r in p["recs"]]
    assert found == sorted(found, key=lambda x: (-x[0], x[1]))


def test_pack_and_unpack(spark, rows):
    lists = spark.createDataFrame(
        [(1, 5, 0.5), (1, 6, 0.9), (1, 7, 0.5), (2, 5, 0.1)], "userId int, productId int, score double"
    )
    ranked = ranking.rank_recs(lists, "userId", 2)
    unpacked = ranking.unpack_recs(ranking.pack_recs(ranked, "userId"), "userId")
    assert rows(unpacked) == [(1, 1, 6, 0.9), (1, 2, 5, 0.5), (2, 1, 5, 0.1)]


def test_numbers_go_on_over_batches():
    keys = [1] * 3 + [2] * 7 + [3] * 2 + [4]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(keys[i : i + 2])], ["k"]) for i in range(0, len(keys), 2)
    ]
    found = [p for b in ranking._numbered(0)(batches) for p in b.column(1).to_pylist()]
    assert found == [1, 2, 3, 1, 2, 3, 4, 5, 6, 7, 1, 2, 1]
