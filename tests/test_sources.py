import pytest

from basketry import schemas, settings
from basketry.operators import statistics
from basketry.plans import jobs
from basketry.sinks import tables as sink
from basketry.sources import files, tables

PRODUCTS = [
    '101^ Mouse "M8" (a,b) ^1057,439^Z1^https://x/31.jpg ^Mice|Office^brand|mouse|good',
    "102^TF card^1057^Z2^https://x/2.jpg^Storage^card|fast|good",
    "103^No tags^1^Z3^https://x/3.jpg^Books^",
]


def write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_product_file(spark, tmp_path):
    df = files.read_products(spark, write(tmp_path / "p.csv", PRODUCTS))
    found = {r["productId"]: r for r in df.collect()}
    assert df.schema.simpleString() == schemas.PRODUCT.simpleString()
    assert found[101]["name"] == 'Mouse "M8" (a,b)'
    assert found[101]["imageUrl"] == "https://x/31.jpg"
    assert found[102]["tags"] == "card|fast|good"
    assert found[103]["tags"] == ""


def test_rating_file(spark, tmp_path, rows):
    path = write(tmp_path / "r.csv", ["41,57,5.0,1395676800", "1,2,3.5,1400000000"])
    assert rows(files.read_ratings(spark, path)) == [
        (1, 2, 3.5, 1400000000),
        (41, 57, 5.0, 1395676800),
    ]


@pytest.mark.parametrize("line", ["x,2,3.0,4", "1,2,3.0", "1,2,3.0,4,5"])
def test_a_bad_row_fails_the_read(spark, tmp_path, line):
    path = write(tmp_path / "r.csv", ["1,2,3.0,4", line])
    with pytest.raises(Exception):
        files.read_ratings(spark, path).collect()


def test_people_counted_by_age_and_sex(spark, tmp_path, rows):
    path = write(tmp_path / "s.txt", ["ann,20,f", "bob,20,m", "cat,20,f"])
    counts = statistics.count_by(files.read_people(spark, path), "age", "sex")
    assert rows(counts) == [(20, "f", 2), (20, "m", 1)]


def test_jobs_from_files_to_tables(spark, tmp_path, rows):
    root = str(tmp_path / "tables")
    users = [(u, p) for u in range(12) for p in (101, 102, 103) if (u * p) % 5 != 1]
    lines = [f"{u},{p},{1 + (u + p) % 5}.0,{1395676800 + u * 86400 * 9}" for u, p in users]
    jobs.load(
        spark, write(tmp_path / "p.csv", PRODUCTS), write(tmp_path / "r.csv", lines), root
    )
    ratings = tables.read_table(spark, root, settings.RATING, schemas.RATING)
    assert ratings.count() == len(users)
    updates = spark.createDataFrame(
        [(0, 101, 5.0, 9, 1), (77, 101, 2.0, 8, 2)],
        "userId int, productId int, score double, order1 bigint, order2 bigint",
    )
    for _ in range(2):
        jobs.merge_updates_job(spark, root, updates)
        ratings = tables.read_table(spark, root, settings.RATING, schemas.RATING)
        assert ratings.count() == len(users) + 1
        assert ratings.where("userId = 0 AND productId = 101").first()["score"] == 5.0
    jobs.statistics_job(spark, root)
    counts = tables.read_table(spark, root, settings.RATE_MORE)
    assert rows(counts) == rows(statistics.rate_more_products(ratings))
    jobs.itemcf_job(spark, root)
    recs = tables.read_table(spark, root, settings.ITEMCF_RECS)
    assert {r["productId"] for r in recs.collect()} == {101, 102, 103}
    jobs.content_job(spark, root, hashed=False)
    assert set(tables.read_table(spark, root, settings.CONTENT_RECS).columns) == {
        "productId",
        "page",
        "recs",
    }
    jobs.user_recs_job(spark, root)
    assert tables.read_table(spark, root, settings.USER_RECS).count() > 0
    jobs.product_recs_job(spark, root)
    best = jobs.als_evaluation_job(spark, root, ranks=(2,), regs=(0.1, 1.0), iterations=2).first()
    assert best["rmse"] > 0


def test_overwrite_replaces(spark, tmp_path):
    for n in (5, 3):
        sink.overwrite(spark.range(n), str(tmp_path), "t")
    assert tables.read_table(spark, str(tmp_path), "t").count() == 3


def test_conform_fails_on_a_value_that_cannot_be_cast(spark):
    df = spark.createDataFrame([("x", 1, 1.0, 1)], "userId string, productId int, score double, timestamp long")
    with pytest.raises(Exception):
        schemas.conform(df, schemas.RATING).collect()


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    """Neither staged nor stored ones, also when threads write beside each other; a table can be read again after."""
    import time
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.sql import functions as F

    from basketry import shared
    from basketry.sinks import tables as sink

    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    counted = [spark.range(1000).groupBy((F.col("id") % n).alias("k")).count() for n in (7, 8, 9)]
    with ThreadPoolExecutor(3) as pool:
        staged = list(pool.map(lambda df: shared.stage(df, "counted"), counted))
    sink.overwrite(counted[0], str(tmp_path), "counted")
    for _ in range(40):
        if not shuffled() - before:
            break
        time.sleep(0.25)
    assert not shuffled() - before
    assert spark.conf.get(shared._CLEANUP, None) is None
    assert [df.count() for df in staged] == [7, 8, 9] and counted[0].count() == 7
