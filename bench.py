"""Time the headline queries and print one JSON line.

Every query is planned from the parquet files and run to its last row; the rows go to a
sink that discards them.
"""

import json
import os
import sys
import time

os.chdir(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.getcwd())

from pyspark.sql import SparkSession  # noqa: E402

from basketry.plans import catalog  # noqa: E402

HEADLINE = (
    "rate_more_products",
    "rate_more_recently",
    "average_products",
    "statistics_all_in_one_scan",
    "hot_products",
    "most_rated_products",
    "search_products",
    "itemcf_pairs",
    "itemcf_top10",
    "content_tfidf_weights",
    "content_profile_similar",
    "content_similar",
    "content_similar_top10",
    "content_lookup",
    "dense_similar",
    "rating_upsert",
    "recent_queue_batch",
    "log_filter_batch",
    "stream_log_filter",
    "stream_recent_queue",
    "statistics_incremental",
    "trending_windowed",
    "als_user_recs",
    "als_recs_lookup",
    "content_pages",
    "content_stored_lookup",
    "hybrid_blend",
    "online_candidates",
    "online_scores",
    "online_factor_scores",
    "factor_user_recs",
    "stream_recs",
    "stream_recs_lookup",
    "stream_online_job",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("basketry-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.rate_more_products(spark, sf_dir).count()  # start-up is not part of any query
    times = {}
    only = sys.argv[1:] or HEADLINE
    for name in only:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
