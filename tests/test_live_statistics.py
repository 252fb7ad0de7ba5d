"""Statistics and windows kept by streams, over several batches, restarts and late events."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from basketry import schemas, settings
from basketry.functions import scalars
from basketry.operators import statistics, trending
from basketry.plans import jobs
from basketry.sinks import tables as sink
from basketry.sources import streams
from basketry.streaming import statistics as live

SCHEMA = "userId bigint, productId bigint, score double, timestamp bigint"
DAY = 86400
START = 1_704_067_200  # 2024-01-01


def some_ratings(seed, n=200):
    rng = random.Random(seed)
    # A third of all ratings are of one product.
    return [
        (rng.randrange(20), rng.choice([1, rng.randrange(9), rng.randrange(9)]), float(rng.randint(1, 5)),
         START + rng.randrange(90 * DAY))
        for _ in range(n)
    ]


def test_statistics_equal_a_full_scan_after_every_batch(spark, rows, tmp_path):
    root, folder = str(tmp_path / "db"), str(tmp_path / "events")
    base = spark.createDataFrame(some_ratings(0), SCHEMA)
    sink.overwrite(schemas.conform(base, schemas.RATING), root, settings.RATING)
    jobs.statistics_job(spark, root)
    assert live.monthly_updates(spark, root).count() == 0
    every = base
    for batch in range(4):
        more = spark.createDataFrame(some_ratings(batch + 1, 50), SCHEMA)
        more.coalesce(1).write.mode("append").parquet(folder)
        every = every.unionByName(more)
        events = streams.parquet_stream(spark, folder, more.schema, max_files=1)
        live.start_monthly(events, root, f"{root}/checkpoint", once=True, fold_every=2).awaitTermination()
        jobs.refresh_statistics_job(spark, root)
        for name, expected, columns in (
            (settings.RATE_MORE, statistics.rate_more_products(every), ("productId", "count")),
            (settings.RATE_MORE_RECENTLY, statistics.rate_more_recently(every), ("productId", "yearmonth", "count")),
            (settings.AVERAGE, statistics.average_products(every), ("productId", "avg")),
        ):
            assert rows(spark.read.parquet(f"{root}/{name}"), *columns) == rows(expected, *columns)
    assert len(sink.batches(spark, root, settings.MONTHLY_UPDATES)) < 4


def test_a_refresh_reads_no_ratings(spark, tmp_path):
    stored = statistics.monthly_profile(spark.createDataFrame([(1, 2, 3.0, START)], SCHEMA))
    sink.overwrite(stored, str(tmp_path), settings.MONTHLY)
    jobs.refresh_statistics_job(spark, str(tmp_path))  # there is no rating table
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/{settings.AVERAGE}").collect()] == [(2, 3.0)]


def test_windows_equal_brute_force(spark, rows):
    data = some_ratings(5) + [(1, 1, 2.0, None)]
    counts, sums = Counter(), defaultdict(float)
    for _, product, score, time in data[:-1]:
        for k in range(4):
            key = ((time // 43200 - k) * 43200, product)
            counts[key] += 1
            sums[key] += score
    got = trending.windowed_counts(spark.createDataFrame(data, SCHEMA))
    assert rows(got) == sorted((s, s + 2 * DAY, p, n, sums[s, p]) for (s, p), n in counts.items())
    best = defaultdict(list)
    for (start, product), n in sorted(counts.items(), key=lambda x: (x[0][0], -x[1], x[0][1])):
        best[start].append((start, product, n, len(best[start]) + 1))
    top = trending.top_per_window(got, 3)
    assert rows(top, "window_start", "productId", "count", "rank") == sorted(r for b in best.values() for r in b[:3])


def test_late_events_count_in_open_windows_only(spark, rows, tmp_path):
    root, folder = str(tmp_path / "db"), str(tmp_path / "events")

    def send(*data):
        spark.createDataFrame([(1, p, 1.0, START + t) for p, t in data], SCHEMA).coalesce(1).write.mode(
            "append"
        ).parquet(folder)
        # A new start of the query goes on from its checkpoint.
        events = streams.parquet_stream(spark, folder, schemas_of(spark), max_files=1)
        live.start_trending(
            events, root, f"{root}/checkpoint", once=True, length="1 day", slide="1 day", delay="1 hour"
        ).awaitTermination()
        closed = live.closed_windows(spark, root)
        return rows(closed.select(((F.col("window_start") - START) / DAY).cast("int"), "productId", "count"))

    assert live.closed_windows(spark, root).count() == 0
    assert send((1, 10), (1, 20), (2, DAY + 100)) == []  # the second day is no hour old
    assert send((1, 30), (1, DAY + 3700)) == [(0, 1, 3)]  # late, but its window was still open
    assert send((1, 40), (2, DAY + 50)) == [(0, 1, 3)]  # the first day is closed: dropped
    assert send((3, 9 * DAY)) == [(0, 1, 3), (1, 1, 1), (1, 2, 2)]
    assert send() == [(0, 1, 3), (1, 1, 1), (1, 2, 2)]


def schemas_of(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_time_of_a_query(spark):
    before, now = spark.range(3).select(F.unix_timestamp().alias("a"), scalars.epoch_now().alias("b")).first()
    assert abs(before - now) <= 1
