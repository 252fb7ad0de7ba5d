"""Quality rules: base counts of a text, and hashed n-gram likelihoods against a trusted corpus.

Words and pairs of neighbouring words are hashed into ``buckets``.  A bucket's weight is the log
ratio of its smoothed share in trusted documents to its share in the whole corpus; a document's
score is the mean weight of its n-grams, and it is kept if the score reaches ``threshold``.
Everything runs as DataFrame functions; only the table of bucket counts, whose size is
``buckets``, comes to the driver.

Defined results: a null or empty text has no words, zero counts, score 0 and fails the base
rule; without labels the trusted corpus is empty and every score is 0; repeated rows are judged
alike; labels with a null id or quality are not trusted.
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import words

BUCKETS = 1 << 16
#: Mean log ratio from which a document is kept.
THRESHOLD = -0.2
#: Trusted documents that are counted, the first by a hash of their id: bounds the broadcast.
MAX_TRUSTED = 20_000
#: Pseudo-counts of every bucket.
SMOOTHING = 4.0
REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
_LONG = "bigint"


def words_of(text: F.Column) -> F.Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \x09-\x0D]+"), "")


def _shifted(array: str) -> F.Column:
    """The array without its first element."""
    return F.slice(array, 2, F.greatest(F.size(array) - 1, F.lit(0)))


def hashed(docs: DataFrame) -> DataFrame:
    """Adds the hash of each word, which n-grams and windows are made of, as ``hashes``."""
    return docs.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def _grams() -> F.Column:
    """Hashes of the words and then of the word pairs of column ``hashes``."""
    pairs = F.zip_with(
        F.slice("hashes", 1, F.greatest(F.size("hashes") - 1, F.lit(0))),
        _shifted("hashes"),
        lambda a, b: F.xxhash64(a, b),
    )
    return F.concat("hashes", pairs)


def _bucket(gram: F.Column, buckets: int) -> F.Column:
    return F.pmod(gram, F.lit(buckets)).cast("int")


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` to ``text, words, hashes``."""
    size = REPEAT_WINDOW
    lines = F.filter(
        F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: line.rlike(r"[^ \x09-\x0D]")
    )
    counted = docs.withColumns(
        {
            "n_words": F.size("words").cast(_LONG),
            "word_chars": F.length(F.array_join("words", "")).cast(_LONG),
            "n_symbols": F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[#*$%&|<>]")).cast(_LONG),
            "lines": lines,
            "windows": F.when(
                F.size("hashes") >= size,
                F.slice(
                    F.transform(
                        "hashes",
                        lambda h, i: F.xxhash64(h, *[F.get("hashes", i + k) for k in range(1, size)]),
                    ),
                    1,
                    F.size("hashes") - size + 1,
                ),
            ).otherwise(F.array().cast("array<bigint>")),
        }
    )
    # Most texts repeat no window; only the others are sorted to find which.
    counted = counted.withColumns(
        {
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast(_LONG),
            "sorted": F.when(
                F.size("windows") > F.size(F.array_distinct("windows")),
                F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            ).otherwise(F.array().cast("array<struct<h: bigint, i: int>>")),
        }
    )
    equal = F.filter(
        F.zip_with("sorted", _shifted("sorted"), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
        lambda p: p["a"]["h"] == p["b"]["h"],
    )
    counted = counted.withColumn("equal", equal)
    at = F.array_sort(
        F.array_distinct(
            F.concat(
                F.transform("equal", lambda p: p["a"]["i"]), F.transform("equal", lambda p: p["b"]["i"])
            )
        )
    )
    counted = counted.withColumn("at", at)
    covered = F.aggregate(
        F.zip_with("at", _shifted("at"), lambda a, b: F.least(F.coalesce(b - a, F.lit(size)), F.lit(size))),
        F.lit(0).cast(_LONG),
        lambda total, step: total + step,
    )
    return counted.withColumn("n_repeat_words", covered).drop("lines", "windows", "sorted", "equal", "at")


def bucket_weights(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, max_trusted: int = MAX_TRUSTED
) -> list[float]:
    """Log ratio of every bucket; the raw corpus is all of ``docs``, the trusted one labelled."""
    trusted = (
        labels.where(F.col("quality") == 1)
        .select("doc_id")
        .dropna()
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_trusted)
        .withColumn("trusted", F.lit(1))
    )
    features = docs.join(F.broadcast(trusted), "doc_id", "left").select(
        F.coalesce("trusted", F.lit(0)).alias("trusted"), F.explode(_grams()).alias("gram")
    )
    counts = features.groupBy(_bucket(F.col("gram"), buckets).alias("bucket")).agg(
        F.count("*").alias("raw"), F.sum("trusted").alias("target")
    )
    raw, target = [0] * buckets, [0] * buckets
    for bucket, n_raw, n_target in counts.collect():  # at most ``buckets`` rows
        raw[bucket], target[bucket] = n_raw, n_target
    if not sum(target):
        return [0.0] * buckets
    # A bucket's expected trusted count; rare buckets say little, so both get pseudo-counts.
    share = sum(target) / sum(raw)
    return [
        math.log((n + SMOOTHING) / (r * share + SMOOTHING)) for n, r in zip(target, raw, strict=True)
    ]


def rate(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
    max_trusted: int = MAX_TRUSTED,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed, kept``.

    With ``carry`` the whole input row comes with them as ``row``.
    """
    own = words.picked(docs, id_col, text_col, carry).withColumn("words", words_of(F.col("text")))
    own = hashed(own)
    weights = bucket_weights(own, labels, buckets, max_trusted)
    # One literal array after constant folding.
    table = F.split(F.lit(",".join(f"{w:.6f}" for w in weights)), ",").cast("array<double>")
    rated = base_counts(own)
    # Summed as the grams are made: no array of buckets or weights is kept beside a text.
    total = F.aggregate(_grams(), F.lit(0.0), lambda s, g: s + F.get(table, _bucket(g, buckets)))
    rated = rated.withColumns(
        {
            "score": F.round(total / F.greatest(2 * F.col("n_words") - 1, F.lit(1)), 6),
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        }
    )
    # The row number, never negative, keeps a filter on ``kept`` from being pushed below these
    # projections, which would repeat their expressions many times over.
    verdict = ~F.col("base_failed") & (F.col("score") >= threshold)
    rated = rated.withColumn("kept", verdict & (F.monotonically_increasing_id() >= 0))
    return rated.drop("text", "words", "hashes")
