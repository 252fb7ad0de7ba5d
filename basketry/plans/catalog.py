"""The package's operators as queries over the order warehouse: ``(spark, sf_dir) -> DataFrame``.

Results are in long form, ids are bigints and scores are rounded to six decimals.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import schemas, settings, shared
from basketry.functions import scalars
from basketry.operators import (
    als,
    blend,
    content,
    itemcf,
    online,
    pruned,
    ranking,
    ratings,
    search,
    serving,
    statistics,
    trending,
)
from basketry.plans import jobs
from basketry.sinks import grid
from basketry.sinks import tables as sink
from basketry.sources import files, streams, tables, warehouse
from basketry.streaming import live_state, log_filter, recent_queue, run
from basketry.streaming import statistics as live_statistics
from basketry.streaming.online import OnlineRecommender, current_rows

_EVENT_ORDER = ("ts", "event_id")
_SEARCH = "red|ring$"
# The last two promise no letter triple and scan.
_SEARCHES = (_SEARCH, "spring.*(blush|green)", "ora?nge?", "l[aeiou]ce", "^.[aeiou]")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns or ("score",)})


def _requests(spark, sf_dir) -> DataFrame:
    """Products somebody asked for: those of purchase events."""
    events = warehouse.events_as_ratings(warehouse.table(spark, sf_dir, "events"))
    return events.where(F.col("event_type") == "purchase").select("productId").distinct()


# Statistics -----------------------------------------------------------------------------


def rate_more_products(spark, sf_dir):
    return statistics.rate_more_products(warehouse.ratings(spark, sf_dir))


def rate_more_recently(spark, sf_dir):
    return statistics.rate_more_recently(warehouse.ratings(spark, sf_dir))


def average_products(spark, sf_dir):
    return _rounded(statistics.average_products(warehouse.ratings(spark, sf_dir)), "avg")


def statistics_all_in_one_scan(spark, sf_dir):
    return _rounded(statistics.statistics_in_one_scan(warehouse.ratings(spark, sf_dir)), "avg")


def statistics_sql_views(spark, sf_dir):
    """The same statistics as SQL text over registered views."""
    rated = warehouse.ratings(spark, sf_dir)
    tables.register(rated, "rating")
    tables.register(statistics.ratings_by_month(rated), "ratingOfMonth")
    return spark.sql(
        """
        SELECT m.productId, m.yearmonth, m.month_count, t.total_count
        FROM (SELECT productId, yearmonth, count(productId) AS month_count
              FROM ratingOfMonth GROUP BY productId, yearmonth) m
        JOIN (SELECT productId, count(productId) AS total_count
              FROM rating GROUP BY productId) t ON m.productId = t.productId
        """
    )


def distinct_ids(spark, sf_dir):
    rated = warehouse.ratings(spark, sf_dir)
    users = statistics.distinct_users(rated).select(F.lit("user").alias("kind"), F.col("userId").alias("id"))
    products = statistics.distinct_products(rated).select(
        F.lit("product").alias("kind"), F.col("productId").alias("id")
    )
    return users.unionByName(products)


def delimited_group_count(spark, sf_dir):
    return statistics.count_by(
        warehouse.table(spark, sf_dir, "customer"), "c_mktsegment", "c_nationkey"
    )


# Serving --------------------------------------------------------------------------------


def _serving(df: DataFrame, *columns) -> DataFrame:
    return _rounded(df).select(*columns, "productId", "name", "categories", "tags", "score")


def _averages(spark, sf_dir, only: DataFrame | None = None) -> DataFrame:
    """Average scores; with ``only`` the ratings of other products are not shuffled."""
    rated = warehouse.ratings(spark, sf_dir)
    if only is not None:
        rated = rated.join(only.select("productId"), "productId", "left_semi")
    return rated.groupBy("productId").agg(F.avg("score").alias("avg"))


def hot_products(spark, sf_dir):
    """Months and averages both come from the monthly profile: one pass over the ratings."""
    monthly = shared.stage(
        statistics.monthly_profile(warehouse.ratings(spark, sf_dir)), "monthly"
    )
    stored = statistics.tables_from_monthly(monthly)
    products = warehouse.products(spark, sf_dir)
    found = serving.hot_products(stored["recent"], products, stored["average"], 20)
    return _serving(found, "yearmonth", "count")


def most_rated_products(spark, sf_dir):
    per_product = (
        warehouse.ratings(spark, sf_dir)
        .groupBy("productId")
        .agg(F.count("productId").alias("count"), F.avg("score").alias("score"))
    )
    top = statistics.most_rated(per_product, 20)
    return _serving(top.join(warehouse.products(spark, sf_dir), "productId"), "count")


def product_info(spark, sf_dir):
    requests = _requests(spark, sf_dir)
    found = serving.product_info(
        requests, warehouse.products(spark, sf_dir), _averages(spark, sf_dir, requests)
    )
    return _serving(found)


def search_products(spark, sf_dir):
    products = warehouse.products(spark, sf_dir)
    named = products.where(F.col("name").rlike(_SEARCH))
    found = serving.search_products(products, _averages(spark, sf_dir, named), _SEARCH)
    return _serving(found)


def search_products_raw(spark, sf_dir):
    """A pattern whose UTF-8 arrived as ISO-8859-1."""
    products = warehouse.products(spark, sf_dir)
    query = f"{_SEARCH}|é".encode().decode("iso-8859-1")
    return _serving(serving.search_products_raw(products, _averages(spark, sf_dir), query))


def _stored_triples(spark, sf_dir) -> tuple[DataFrame, ...]:
    root = shared.run_dir(spark, "search")
    sink.overwrite_clustered(warehouse.products(spark, sf_dir), root, settings.PRODUCT, "productId")
    jobs.search_index_job(spark, root)
    return tuple(
        tables.read_table(spark, root, name)
        for name in (settings.PRODUCT, settings.TRIPLES, settings.TRIPLE_COUNTS)
    )


def search_triples(spark, sf_dir):
    """The search index: how many products have each letter triple in their name."""
    return _stored_triples(spark, sf_dir)[2]


def search_products_indexed(spark, sf_dir):
    """Several patterns by the stored index."""
    products, posted, counts = _stored_triples(spark, sf_dir)
    found = [
        search.matching(products, posted, counts, pattern).withColumn("pattern", F.lit(pattern))
        for pattern in _SEARCHES
    ]
    named = shared.stage(reduce(DataFrame.unionByName, found), "found")
    averages = _averages(spark, sf_dir, named.select("productId").distinct())
    return _serving(serving.with_average(named, averages), "pattern")


# Item-CF --------------------------------------------------------------------------------


def itemcf_pairs(spark, sf_dir):
    return _rounded(itemcf.cooccurrence_pairs(warehouse.ratings(spark, sf_dir)))


def itemcf_top10(spark, sf_dir):
    return _rounded(itemcf.cooccurrence_top(warehouse.ratings(spark, sf_dir)))


def itemcf_recs(spark, sf_dir):
    """The stored form: one row per rated product, its list shown as text."""
    recs = itemcf.itemcf_recs(warehouse.ratings(spark, sf_dir))
    return recs.select(
        "productId",
        F.size("recs").alias("n_recs"),
        F.array_join(F.transform("recs", lambda r: r["productId"].cast("string")), ",").alias("ids"),
    )


def itemcf_lookup(spark, sf_dir):
    requests = _requests(spark, sf_dir)
    top = itemcf.requested_top(warehouse.ratings(spark, sf_dir), requests)
    found = serving.product_recs(
        requests,
        ranking.pack_recs(top, "productId", item="recId"),
        warehouse.products(spark, sf_dir),
        _averages(spark, sf_dir),
    )
    return _rounded(found, "score", "rec_score").select(
        "requested", "rank", "productId", "rec_score", "name", "score"
    )


# Content --------------------------------------------------------------------------------


def _words(spark, sf_dir) -> DataFrame:
    return content.tokens(warehouse.products(spark, sf_dir))


def content_tfidf_weights(spark, sf_dir):
    return _rounded(content.tfidf_weights(_words(spark, sf_dir)), "weight")


def content_profile_similar(spark, sf_dir):
    profiles = content.Profiles(_words(spark, sf_dir))
    return _rounded(content.profile_similarity(profiles.weights))


def content_similar(spark, sf_dir):
    return content.similar_products(_words(spark, sf_dir), decimals=6)


def content_similar_top10(spark, sf_dir):
    return _rounded(content.top_similar(_words(spark, sf_dir), 10))


def content_hashed_counts(spark, sf_dir):
    """Hashed term features: how often each bucket occurs in a product's tags."""
    words = content.hashed_tokens(warehouse.products(spark, sf_dir))
    return (
        words.select("productId", F.explode(F.col("words").cast("array<int>")).alias("bucket"))
        .groupBy("productId", "bucket")
        .agg(F.count("*").alias("tf"))
    )


def content_similar_hashed(spark, sf_dir):
    words = content.hashed_tokens(warehouse.products(spark, sf_dir))
    return content.similar_products(words, decimals=6)


def content_pages(spark, sf_dir):
    """The stored form of the whole lists, in pages of bounded length."""
    return _page_texts(content.similar_pages(_words(spark, sf_dir), page_size=50, decimals=6))


def _page_texts(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("product1").alias("productId"),
        "page",
        F.size("recs").alias("n_recs"),
        F.array_join(F.transform("recs", lambda r: r["productId"].cast("string")), ",").alias("ids"),
    )


_LOOKUP = ("requested", "rank", "productId", "rec_score", "name", "score")


def content_lookup(spark, sf_dir):
    """The whole lists of the requested products, worked out for them only."""
    lists = content.similar_products(_words(spark, sf_dir), requests=_requests(spark, sf_dir))
    rows = ranking.list_rank(lists, "product1", "product2").select(
        F.col("product1").alias("requested"),
        "rank",
        F.col("product2").alias("productId"),
        F.col("score").alias("rec_score"),
    )
    found = serving.with_average(
        rows.join(warehouse.products(spark, sf_dir), "productId"), _averages(spark, sf_dir)
    )
    return _rounded(found, "score", "rec_score").select(*_LOOKUP)


def content_stored_lookup(spark, sf_dir):
    """The same lists from the table of pages that the content job stores."""
    root = shared.run_dir(spark, "content")
    products = warehouse.products(spark, sf_dir)
    sink.overwrite(products, root, settings.PRODUCT)
    jobs.content_job(spark, root, hashed=False)
    pages = tables.read_table(spark, root, settings.CONTENT_RECS)
    found = serving.paged_recs(
        _requests(spark, sf_dir), pages, products, _averages(spark, sf_dir), settings.PAGE_SIZE
    )
    return _rounded(found, "score", "rec_score").select(*_LOOKUP)


def dense_similar(spark, sf_dir):
    return _rounded(pruned.similar(warehouse.dense_vectors(spark, sf_dir)))


# Rating maintenance ---------------------------------------------------------------------


def _base_ratings(spark, sf_dir) -> DataFrame:
    """Ratings with one row per (user, product)."""
    return ratings.last_ratings(warehouse.ratings(spark, sf_dir), ("timestamp", "score"))


def rating_upsert(spark, sf_dir):
    return ratings.upsert(
        _base_ratings(spark, sf_dir), warehouse.rating_events(spark, sf_dir), _EVENT_ORDER
    )


def _queue(spark, sf_dir, n=settings.QUEUE_SIZE) -> DataFrame:
    return ratings.recent_queue(warehouse.rating_events(spark, sf_dir), _EVENT_ORDER, n)


def recent_queue_batch(spark, sf_dir):
    return _queue(spark, sf_dir).select("userId", "rank", "productId", "score")


def recent_queue_items(spark, sf_dir):
    """Queue as texts and back, positions the scorer reads."""
    items = ratings.queue_items(_queue(spark, sf_dir))
    return ratings.recent_ratings(ratings.parse_queue_items(items))


def _asked() -> Column:
    """Events of the second half of the month are rating requests, earlier ones were queued."""
    return F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")


def _rating_requests(spark, sf_dir) -> DataFrame:
    """Rating requests on the 0-10 scale."""
    return warehouse.rating_events(spark, sf_dir).where(_asked()).withColumn(
        "score", (F.col("event_id") % 41).cast("double") / 4
    )


def score_halving(spark, sf_dir):
    return ratings.halve_requests(_rating_requests(spark, sf_dir)).select("event_id", "score")


def _rate(spark, sf_dir) -> dict[str, DataFrame]:
    return ratings.rate(
        _base_ratings(spark, sf_dir),
        ratings.recent_queue(warehouse.rating_events(spark, sf_dir).where(~_asked()), _EVENT_ORDER),
        _rating_requests(spark, sf_dir),
        _EVENT_ORDER,
    )


def rate_products(spark, sf_dir):
    return _rate(spark, sf_dir)["ratings"]


def rate_products_queue(spark, sf_dir):
    return _rate(spark, sf_dir)["queue"].select("userId", "rank", "productId", "score")


def rate_products_log(spark, sf_dir):
    return _rate(spark, sf_dir)["log"]


def user_id_from_name(spark, sf_dir):
    customers = warehouse.table(spark, sf_dir, "customer")
    return customers.select("c_name", scalars.user_id_from_name("c_name").alias("userId"))


def tag_aggregate(spark, sf_dir):
    """Event types of a product's events stand for the tags users gave it."""
    events = warehouse.events_as_ratings(warehouse.table(spark, sf_dir, "events"))
    return ratings.aggregate_tags(events.select("productId", F.col("event_type").alias("tag")))


# Files and tables -----------------------------------------------------------------------


def load_products(spark, sf_dir):
    """Products through the delimited file format and the initial load."""
    folder = shared.run_dir(spark, "load")
    products = warehouse.products(spark, sf_dir)
    lines = products.select(
        F.concat_ws(
            settings.PRODUCT_SEPARATOR,
            F.col("productId").cast("string"),
            F.concat(F.lit(" "), "name", F.lit(" ")),
            F.lit("1,2"),
            F.lit("X"),
            "imageUrl",
            "categories",
            "tags",
        )
    )
    lines.write.text(f"{folder}/products")
    read = files.read_products(spark, f"{folder}/products")
    sink.overwrite_clustered(read, folder, settings.PRODUCT, "productId")
    return tables.read_table(spark, folder, settings.PRODUCT, schemas.PRODUCT)


def load_ratings(spark, sf_dir):
    folder = shared.run_dir(spark, "load")
    fields = [F.col(c).cast("string") for c in ("userId", "productId", "score", "timestamp")]
    lines = warehouse.ratings(spark, sf_dir).select(F.concat_ws(",", *fields))
    lines.write.text(f"{folder}/ratings")
    read = files.read_ratings(spark, f"{folder}/ratings")
    grid.write(read, folder, settings.RATING)
    return tables.read_table(spark, folder, settings.RATING, schemas.RATING)


def rating_merge(spark, sf_dir):
    """The upsert of a stored table, cell by cell: only cells with an event are read and written."""
    folder = shared.run_dir(spark, "merge")
    grid.write(_base_ratings(spark, sf_dir), folder, settings.RATING)
    grid.merge(
        spark,
        folder,
        settings.RATING,
        warehouse.rating_events(spark, sf_dir),
        lambda base, events: ratings.upsert(base, events, _EVENT_ORDER),
    )
    return tables.read_table(spark, folder, settings.RATING, schemas.RATING)


def rating_lookup(spark, sf_dir):
    """Ratings by the customers of one nation, and of the smallest parts, from the cells they are in."""
    folder = shared.run_dir(spark, "lookup")
    grid.write(warehouse.ratings(spark, sf_dir), folder, settings.RATING)
    users = warehouse.table(spark, sf_dir, "customer").where("c_nationkey = 7")
    parts = warehouse.table(spark, sf_dir, "part").where("p_size = 1")
    asked = {
        "userId": users.select(F.col("c_custkey").alias("userId")),
        "productId": parts.select(F.col("p_partkey").alias("productId")),
    }
    found = [
        grid.lookup(spark, folder, settings.RATING, requests, key)
        .select(F.lit(key).alias("by"), "userId", "productId", "score", "timestamp")
        for key, requests in asked.items()
    ]
    return found[0].unionByName(found[1])


# Logs and streams -----------------------------------------------------------------------


def log_emit(spark, sf_dir):
    return ratings.rating_log_lines(warehouse.rating_events(spark, sf_dir))


def log_filter_batch(spark, sf_dir):
    lines = warehouse.events_as_log_lines(warehouse.table(spark, sf_dir, "events"))
    return log_filter.parse_events(log_filter.extract_payloads(lines))


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.table_stream(spark, f"{sf_dir}/events.parquet")


def stream_log_filter(spark, sf_dir):
    """Log lines through a streaming query into a table, then parsed."""
    folder = shared.run_dir(spark, "log")
    lines = warehouse.events_as_log_lines(_event_stream(spark, sf_dir)).select("value")
    query = log_filter.start_filter(
        lines,
        {"format": "parquet", "path": f"{folder}/product"},
        f"{folder}/checkpoint",
        once=True,
    )
    query.awaitTermination()
    payloads = spark.read.schema("value string").parquet(f"{folder}/product")
    return log_filter.parse_events(payloads)


def stream_log_tail(spark, sf_dir):
    """Rotated log files to events; more files are rotated out while the query is down."""
    folder = shared.run_dir(spark, "tail")
    lines = warehouse.events_as_log_lines(warehouse.table(spark, sf_dir, "events"))
    tasks = shared.task_count(spark)
    for late in (False, True):
        some = lines.where((F.pmod(F.xxhash64("event_id"), F.lit(4)) == 0) == F.lit(late))
        some.select("value").repartition(tasks).write.mode("append").option("maxRecordsPerFile", 20_000).text(f"{folder}/log")
        tail = streams.rotated_log(spark, f"{folder}/log", "part-*", f"{folder}/archive", max_files=4 * tasks)
        log_filter.start_tail(tail, folder, f"{folder}/checkpoint", once=True).awaitTermination()
    return log_filter.logged(spark, folder).drop("batch")


def _ordered_event_stream(spark, sf_dir) -> DataFrame:
    return warehouse.events_as_ratings(_event_stream(spark, sf_dir)).select(
        "userId",
        "productId",
        "score",
        F.col("timestamp").alias("order1"),
        F.col("event_id").alias("order2"),
    )


def stream_recent_queue(spark, sf_dir):
    """The queue kept as state of a streaming query."""
    folder = shared.run_dir(spark, "queue")
    events = _ordered_event_stream(spark, sf_dir)
    recent_queue.start_queue(events, folder, f"{folder}/checkpoint", once=True).awaitTermination()
    return recent_queue.current_queue(spark, folder).select(
        "userId", "rank", "productId", "score"
    )


def state_recent_queue(spark, sf_dir):
    """The same queue, read from the state of a query that writes no table."""
    folder = shared.run_dir(spark, "queue-state")
    stream = recent_queue.queue_stream(_ordered_event_stream(spark, sf_dir))
    with recent_queue.keyed_state(spark):
        writer = stream.writeStream.outputMode("update").format("noop")
        run.start(writer, f"{folder}/checkpoint", once=True).awaitTermination()
    return live_state.queue_in_state(spark, f"{folder}/checkpoint")


def statistics_incremental(spark, sf_dir):
    """Monthly and total counts and averages of ratings and streamed events, no rating read twice."""
    root = shared.run_dir(spark, "statistics")
    stored = shared.stage(statistics.monthly_profile(warehouse.ratings(spark, sf_dir)), "monthly")
    events = warehouse.events_as_ratings(_event_stream(spark, sf_dir))
    live_statistics.start_monthly(events, root, f"{root}/checkpoint", once=True).awaitTermination()
    monthly = live_statistics.merged_monthly(stored, live_statistics.monthly_updates(spark, root))
    return _rounded(statistics.all_from_monthly(monthly), "avg")


def _trends(counts: DataFrame) -> DataFrame:
    return trending.top_per_window(counts).select(
        "window_start", "window_end", "rank", "productId", "count", "score_sum"
    )


def trending_windowed(spark, sf_dir):
    """Most rated products of every sliding window of event time."""
    return _trends(trending.windowed_counts(warehouse.rating_events(spark, sf_dir)))


def stream_trending(spark, sf_dir):
    """The same of the windows that a stream has closed."""
    root = shared.run_dir(spark, "trending")
    events = warehouse.events_as_ratings(_event_stream(spark, sf_dir))
    live_statistics.start_trending(events, root, f"{root}/checkpoint", once=True).awaitTermination()
    return _trends(live_statistics.closed_windows(spark, root))


# Online recommendation ------------------------------------------------------------------


def _similarity(spark, sf_dir) -> online.Similarity:
    return online.TagProfiles(_words(spark, sf_dir))


def _factor_similarity(spark, sf_dir) -> online.Similarity:
    """Vectors of ``embeddings`` as item factors, so that no training is between data and result.

    There are fewer vectors than products: the products with a vector take part.
    """
    return online.FactorVectors(warehouse.dense_vectors(spark, sf_dir))


def _rated(spark, sf_dir) -> DataFrame:
    columns = ("userId", "productId")
    return (
        warehouse.ratings(spark, sf_dir)
        .select(*columns)
        .unionByName(warehouse.rating_events(spark, sf_dir).select(*columns))
    )


def _triggers(spark, sf_dir) -> DataFrame:
    events = warehouse.rating_events(spark, sf_dir)
    return online.latest_event(events, _EVENT_ORDER).select("userId", "productId")


def latest_events(spark, sf_dir):
    return online.latest_event(warehouse.rating_events(spark, sf_dir), _EVENT_ORDER).select(
        "userId", "productId", "score", "timestamp", "event_id"
    )


def online_candidates(spark, sf_dir):
    found = online.candidates(
        _triggers(spark, sf_dir), _rated(spark, sf_dir), _similarity(spark, sf_dir)
    )
    return _rounded(found)


def _online_scores(spark, sf_dir) -> DataFrame:
    sim = _similarity(spark, sf_dir)
    found = online.candidates(_triggers(spark, sf_dir), _rated(spark, sf_dir), sim)
    return online.score_candidates(found, _queue(spark, sf_dir, settings.N_RECENT), sim)


def online_scores(spark, sf_dir):
    return _rounded(_online_scores(spark, sf_dir))


def _near_triggers(spark, sf_dir) -> Callable[[DataFrame], DataFrame]:
    """Trigger events moved onto products with a vector: few events name one."""
    n = warehouse.dense_vectors(spark, sf_dir).agg(F.max("id")).first()[0] + 1
    return lambda df: df.withColumn("productId", (F.col("productId") % n).cast(df.schema["productId"].dataType))


def online_factor_candidates(spark, sf_dir):
    """The live path on latent factors."""
    place = _near_triggers(spark, sf_dir)
    found = online.candidates(
        place(_triggers(spark, sf_dir)), _rated(spark, sf_dir), _factor_similarity(spark, sf_dir)
    )
    return _rounded(found)


def online_factor_scores(spark, sf_dir):
    place = _near_triggers(spark, sf_dir)
    sim = _factor_similarity(spark, sf_dir)
    found = online.candidates(place(_triggers(spark, sf_dir)), _rated(spark, sf_dir), sim)
    recents = place(_queue(spark, sf_dir, settings.N_RECENT))
    return _rounded(online.score_candidates(found, recents, sim, min_sim=settings.MIN_SIMILARITY))


def _run_online(spark, sf_dir) -> OnlineRecommender:
    folder = shared.run_dir(spark, "online")
    sim = _similarity(spark, sf_dir)
    recommender = OnlineRecommender(
        spark, folder, lambda: sim, lambda: warehouse.ratings(spark, sf_dir)
    )
    events = _ordered_event_stream(spark, sf_dir)
    recommender.start_updates(events, f"{folder}/updates", once=True).awaitTermination()
    recommender.start(events, f"{folder}/checkpoint", once=True).awaitTermination()
    return recommender


def stream_recs(spark, sf_dir):
    """The live path end to end: state, candidates, scores, replaced lists."""
    return _rounded(_run_online(spark, sf_dir).current_rows())


def stream_recs_lookup(spark, sf_dir):
    """Stream lists of the customers of one market segment, asked for by name."""
    customers = warehouse.table(spark, sf_dir, "customer")
    users = customers.select(
        F.col("c_custkey").cast("bigint").alias("userId"), F.col("c_name").alias("username")
    )
    wanted = customers.where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_name").alias("username")
    )
    found = serving.user_recs(
        wanted,
        users,
        _run_online(spark, sf_dir).current_recs(),
        warehouse.products(spark, sf_dir),
        _averages(spark, sf_dir),
        5,
    )
    return _rounded(found, "score", "rec_score").select(
        "username", "requested", "rank", "productId", "rec_score", "name", "score"
    )


def stream_online_job(spark, sf_dir):
    """From log lines to replaced lists: the whole live path as one job."""
    root = shared.run_dir(spark, "online-job")
    sink.overwrite(warehouse.ratings(spark, sf_dir), root, settings.RATING)
    lines = warehouse.events_as_log_lines(_event_stream(spark, sf_dir)).select("value")
    sim = _similarity(spark, sf_dir)
    for query in jobs.online_job(spark, root, lines, lambda: sim, once=True):
        query.awaitTermination()
    return _rounded(current_rows(spark, root))


def _two_batches(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Each user's rated products before the last day, and on it, best first."""
    events = warehouse.rating_events(spark, sf_dir)
    last_day = F.col("ts") >= F.lit("2024-01-30").cast("timestamp_ntz")

    def best(part: DataFrame) -> DataFrame:
        means = part.groupBy("userId", "productId").agg(F.avg("score").alias("score"))
        return ranking.list_rank(means, "userId")

    return best(events.where(~last_day)), best(events.where(last_day))


def replace_stream_recs(spark, sf_dir):
    """Lists of earlier events, replaced for the users active on the last day."""
    earlier, later = _two_batches(spark, sf_dir)
    lists = online.replace_recs(
        ranking.pack_recs(earlier, "userId"), ranking.pack_recs(later, "userId")
    )
    return _rounded(ranking.unpack_recs(lists, "userId")).select(
        "userId", "rank", "productId", "score"
    )


def merge_stream_recs(spark, sf_dir):
    earlier, later = _two_batches(spark, sf_dir)
    return _rounded(blend.merge_stream_recs(earlier, later))


def hybrid_blend(spark, sf_dir):
    """Item-CF lists and whole content lists of the last rated product, and online scores."""
    triggers = shared.stage(_triggers(spark, sf_dir), "triggers")
    asked = triggers.select("productId").distinct()
    offline = itemcf.requested_top(warehouse.ratings(spark, sf_dir), asked).select(
        F.col("productId").alias("trigger"), F.col("recId").alias("productId"), "score"
    )
    whole = content.similar_products(_words(spark, sf_dir), requests=asked).select(
        F.col("product1").alias("trigger"), F.col("product2").alias("productId"), "score"
    )
    return _rounded(
        blend.blend_by_trigger(
            triggers.withColumnRenamed("productId", "trigger"),
            {"offline": (offline, 0.5), "content": (whole, 0.2)},
            {"stream": (_online_scores(spark, sf_dir), 0.3)},
        )
    )


# Latent factors -------------------------------------------------------------------------


def _model(spark, sf_dir):
    return als.fit(als.training_triples(warehouse.ratings(spark, sf_dir)))


def als_user_recs(spark, sf_dir):
    return _rounded(ranking.unpack_recs(als.user_recs(_model(spark, sf_dir)), "userId"))


def als_product_similar(spark, sf_dir):
    """The whole lists of similar products, in the stored form of pages."""
    return _page_texts(als.product_pages(_model(spark, sf_dir)))


def als_grid(spark, sf_dir):
    grid = shared.stage(als.grid(warehouse.ratings(spark, sf_dir)), "grid")
    best = als.best_parameters(grid).select("rank", "lambda", F.lit(True).alias("best"))
    return grid.join(best, ["rank", "lambda"], "left").withColumn(
        "best", F.coalesce("best", F.lit(False))
    )


def als_recs_lookup(spark, sf_dir):
    customers = warehouse.table(spark, sf_dir, "customer")
    users = customers.select(
        F.col("c_custkey").cast("bigint").alias("userId"), F.col("c_name").alias("username")
    )
    wanted = customers.where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_name").alias("username")
    )
    asked = users.join(wanted, "username", "left_semi")
    return serving.user_recs(
        wanted,
        users,
        als.user_recs(_model(spark, sf_dir), requests=asked),
        warehouse.products(spark, sf_dir),
        _averages(spark, sf_dir),
        10,
    )


def _factors(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Vectors of even number as user factors, of odd number as item factors."""
    vectors = warehouse.dense_vectors(spark, sf_dir)

    def half(odd: int) -> DataFrame:
        number = F.floor(F.col("id") / 2).cast(vectors.schema["id"].dataType)
        return vectors.where(F.col("id") % 2 == odd).select(number.alias("id"), "features")

    return half(0), half(1)


def _factor_ratings(spark, sf_dir) -> DataFrame:
    """Ratings of users and products moved onto those with factors."""
    n = warehouse.dense_vectors(spark, sf_dir).agg(F.max("id")).first()[0] // 2 + 1
    rated = _base_ratings(spark, sf_dir)
    moved = {c: (F.col(c) % n).cast(rated.schema[c].dataType) for c in ("userId", "productId")}
    return rated.withColumns(moved)


def factor_predictions(spark, sf_dir):
    """Observed joined to predicted on (user, product)."""
    rated = _factor_ratings(spark, sf_dir).select("userId", "productId", "score")
    return _rounded(als.factor_predictions(rated, *_factors(spark, sf_dir)), "prediction")


def factor_rmse(spark, sf_dir):
    rated = _factor_ratings(spark, sf_dir)
    return _rounded(als.rmse(als.factor_predictions(rated, *_factors(spark, sf_dir))), "rmse")


def factor_user_recs(spark, sf_dir):
    return _rounded(als.factor_user_recs(*_factors(spark, sf_dir)))


def factor_recs_lookup(spark, sf_dir):
    """Recommendations of the customers of one segment: only their factors are multiplied."""
    users, items = _factors(spark, sf_dir)
    asked = warehouse.table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    asked = asked.select(F.col("c_custkey").cast(users.schema["id"].dataType).alias("id"))
    found = als.factor_user_recs(users.join(asked, "id", "left_semi"), items, 10)
    rows = found.withColumnRenamed("score", "rec_score").join(
        warehouse.products(spark, sf_dir).select("productId", "name"), "productId"
    )
    return _rounded(rows, "rec_score")


def factor_grid(spark, sf_dir):
    """Factors cut to several ranks, the error of each, and the best."""
    users, items = _factors(spark, sf_dir)
    rated = _factor_ratings(spark, sf_dir)

    errors = als.factor_errors(rated, users, items, settings.GRID_RANKS)
    grid = shared.stage(errors.select("rank", F.lit(0.0).alias("lambda"), "rmse"), "grid")
    best = als.best_parameters(grid).select("rank", F.lit(True).alias("best"))
    found = grid.join(best, "rank", "left").withColumn("best", F.coalesce("best", F.lit(False)))
    return _rounded(found, "rmse")


def rmse_of_product_means(spark, sf_dir):
    """Observed joined to predicted, the product's mean being the prediction."""
    rated = warehouse.ratings(spark, sf_dir)
    means = rated.groupBy("productId").agg(F.avg("score").alias("prediction"))
    return _rounded(als.rmse(rated.join(means, "productId")), "rmse")


QUERIES = {
    f.__name__: f
    for f in (
        rate_more_products,
        rate_more_recently,
        average_products,
        statistics_all_in_one_scan,
        statistics_sql_views,
        distinct_ids,
        delimited_group_count,
        hot_products,
        most_rated_products,
        product_info,
        search_products,
        search_products_raw,
        search_triples,
        search_products_indexed,
        itemcf_pairs,
        itemcf_top10,
        itemcf_recs,
        itemcf_lookup,
        content_tfidf_weights,
        content_profile_similar,
        content_similar,
        content_similar_top10,
        content_hashed_counts,
        content_similar_hashed,
        content_pages,
        content_lookup,
        content_stored_lookup,
        dense_similar,
        rating_upsert,
        rating_merge,
        rating_lookup,
        recent_queue_batch,
        recent_queue_items,
        score_halving,
        rate_products,
        rate_products_queue,
        rate_products_log,
        user_id_from_name,
        tag_aggregate,
        load_products,
        load_ratings,
        log_emit,
        log_filter_batch,
        stream_log_filter,
        stream_log_tail,
        stream_recent_queue,
        state_recent_queue,
        statistics_incremental,
        trending_windowed,
        stream_trending,
        latest_events,
        online_candidates,
        online_scores,
        online_factor_candidates,
        online_factor_scores,
        stream_recs,
        stream_recs_lookup,
        stream_online_job,
        replace_stream_recs,
        merge_stream_recs,
        hybrid_blend,
        factor_predictions,
        factor_rmse,
        factor_user_recs,
        factor_recs_lookup,
        factor_grid,
        als_user_recs,
        als_product_similar,
        als_grid,
        als_recs_lookup,
        rmse_of_product_means,
    )
}
