"""The training-data pipeline: five stages over ``documents``, each written and read again.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept.  All but
the last return the columns they were given; rows with a null id take part like others and are
only left out of the near-duplicate classes, which keeps them.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from basketry import shared
from basketry.llm import bpe, decontamination, near_dedup, pii, quality_rules
from basketry.llm.queries import tokenizer_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rated = quality_rules.rate(docs, _table(spark, sf_dir, "labels"), carry=True)
    return rated.where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one of the smallest id; one row for an id and text.

    Where an id has several texts, each is judged by itself, in order of the id and a digest.
    """
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")))
    alone = docs.where(F.col("doc_id").isNull())
    several = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(digest).alias("first"), F.max(digest).alias("last")
    )
    if several.where("first < last").isEmpty():
        kept = near_dedup.classes(docs).where("doc_id = class_id").select("doc_id")
        return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).unionByName(alone)

    number = F.col("doc_id").cast("string")
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        # As digits whose order is that of the ids.
        number = F.lpad((F.col("doc_id").cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")).cast("string"), 20, "0")
    name = "key" + "_" * max(map(len, docs.columns))
    keyed = docs.withColumn(name, F.concat(number, F.lit("\x01"), digest))
    kept = near_dedup.classes(keyed, id_col=name).where("doc_id = class_id").select(F.col("doc_id").alias(name))
    return keyed.join(kept, name, "left_semi").dropDuplicates([name]).select(docs.columns).unionByName(alone)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    scanned = decontamination.scan(docs, _table(spark, sf_dir, "benchmark"), carry=True)
    return scanned.where(F.size("spans") == 0).select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, spans of personal data replaced by their kind in brackets."""
    found = pii.find(docs, pii.learn(docs), carry=True)
    text = F.coalesce("masked", "row.text")
    new = {"text": text} | ({"n_chars": F.length(text).cast("bigint")} if "n_chars" in docs.columns else {})
    return found.select(
        *[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns]
    )


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256`` of all documents."""
    encoded = bpe.encode(docs, tokenizer_path())
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("personal_data", personal_data),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: Hashes, training and tokenization have no SQL form; the tests compare with brute force.
ORACLE_SQL = None
