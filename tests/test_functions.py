import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from basketry.functions import scalars


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_change_date_is_year_month(spark):
    assert one(spark, scalars.change_date(F.lit(1395676800))) == 201403


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_time_functions_do_not_follow_the_session_zone(spark, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        # 2014-03-31 23:30 UTC is April in Shanghai.
        assert one(spark, scalars.change_date(F.lit(1396308600))) == 201403
        assert one(spark, scalars.change_date(F.lit(1396308600), "Asia/Shanghai")) == 201404
        ts = F.lit("2014-03-31 23:30:00.75").cast("timestamp_ntz")
        assert one(spark, scalars.epoch_seconds(ts)) == 1396308600
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_milliseconds_become_seconds(spark):
    assert one(spark, scalars.normalise_epoch(F.lit(1564754545123), "ms")) == 1564754545
    assert one(spark, scalars.normalise_epoch(F.lit(1564754545))) == 1564754545


@pytest.mark.parametrize("given, stored", [(9.0, 4.5), (0.25, 0.13), (10.0, 5.0), (0.0, 0.0)])
def test_score_halving_rounds_half_up(spark, given, stored):
    assert one(spark, scalars.halve_score(F.lit(given))) == stored


def polynomial_hash(text):
    units = text.encode("utf-16-be")
    h = 0
    for i in range(0, len(units), 2):
        h = (31 * h + int.from_bytes(units[i : i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


@pytest.mark.parametrize("name", ["hello", "", "a", "héllo", "名前", "smile😀x", "z" * 200])
def test_user_id_from_name(spark, name):
    assert one(spark, scalars.user_id_from_name(F.lit(name))) == polynomial_hash(name)


def test_user_id_known_value(spark):
    assert one(spark, scalars.user_id_from_name(F.lit("hello"))) == 99162322


def test_query_text_is_decoded_again(spark):
    garbled = "鼠标 café".encode().decode("iso-8859-1")
    assert one(spark, scalars.redecode_query(F.lit(garbled))) == "鼠标 café"


def test_log_line_and_queue_item(spark):
    line = scalars.log_line(F.lit(1), F.lit(2), F.lit(3.5), F.lit(1564754545))
    assert one(spark, line) == "PRODUCT_RATING_PREFIX:1|2|3.5|1564754545"
    assert tuple(one(spark, scalars.parse_queue_item(F.lit(" 12 : 4.5 ")))) == (12, 4.5)
    assert one(spark, scalars.queue_item(F.lit(12), F.lit(4.5))) == "12:4.5"


def test_cosine_of_a_zero_vector_is_null(spark):
    zero, unit = F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(3.0), F.lit(4.0))
    assert one(spark, scalars.cosine(zero, unit)) is None
    assert one(spark, scalars.cosine(unit, unit)) == pytest.approx(1.0)
    assert one(spark, scalars.log2(F.lit(8))) == 3.0


def test_similarity_of_very_large_counts(spark):
    big = F.lit(300_000_000_000).cast("bigint")
    assert one(spark, scalars.cooccurrence_similarity(big, big, big)) == pytest.approx(1.0)


def test_name_hash_counts_every_code_unit(spark):
    names = ["", "a", "a\0b", "\0", "tail\0", "é🎉"]

    def java_hash(text):
        units = text.encode("utf-16-be")
        value = 0
        for i in range(0, len(units), 2):
            value = (value * 31 + int.from_bytes(units[i : i + 2], "big")) % (1 << 32)
        return value - (1 << 32) if value >= 1 << 31 else value

    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = df.select("name", scalars.user_id_from_name("name").alias("id")).collect()
    assert {r["name"]: r["id"] for r in found} == {n: java_hash(n) for n in names}


def test_term_buckets_are_those_of_mllib(spark):
    terms = ["", "a", "ab", "abc", "abcd", "abcde", "abcdefg", "富勒", "é", "😀x", "x" * 1000]
    terms += [f"word{n * n}" for n in range(500)]
    df = spark.createDataFrame([(t, [t]) for t in terms], "term string, terms array<string>")
    for size in (800, 7, 1 << 18):
        hashed = HashingTF(inputCol="terms", outputCol="tf", numFeatures=size).transform(df)
        for row in hashed.withColumn("bucket", scalars.term_bucket("term", size)).collect():
            assert [row["bucket"]] == row["tf"].indices.tolist()
