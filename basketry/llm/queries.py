"""The operators of this subpackage as queries over the given tables."""

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import (
    bpe,
    decontamination,
    embedding_near_dedup,
    html_extraction,
    lm_scoring,
    near_dedup,
    periodic_runs,
    pii,
    quality_rules,
    source_divergence,
    substring_dedup,
    toxicity,
    url_filters,
)


def tokenizer_path() -> str:
    """Where the public tokenizer files are; ``BASKETRY_TOKENIZER`` names another file."""
    if named := os.environ.get("BASKETRY_TOKENIZER"):
        return named
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark, sf_dir):
    found = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_lm_scoring(spark, sf_dir):
    return lm_scoring.score(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark, sf_dir):
    rated = quality_rules.rate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return rated.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "score",
    )


def op4_minhash(spark, sf_dir):
    return near_dedup.classes(_table(spark, sf_dir, "documents"))


def _fetched() -> F.Column:
    """Pages carry no fetch day: it is read off the page id, within a year."""
    return F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 360).cast("int"))


def _list_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of the pages: named abusers, and hosts by their first page."""
    hosts = (
        pages.select(url_filters.host_of(F.col("url")).alias("host"), "page_id")
        .where("host IS NOT NULL")
        .groupBy("host")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    )
    start = F.lit("2024-01-01").cast("date")
    domain = F.regexp_replace("host", r"^(www|m|blog)\.", "")

    def entry(name, category, day, action, where):
        return hosts.where(where).select(
            name.alias("domain"), category.alias("category"), day.alias("day"), F.lit(action).alias("action")
        )

    shift = lambda days: F.date_add(start, days.cast("int"))
    abuse = F.regexp_extract("host", "(spam|pills|adult)", 1)
    report = F.when(F.col("first") % 2 == 0, "report").otherwise("phishing")
    added = F.col("first") % 300
    return (
        entry(domain, abuse, shift(F.lit(20)), "add", "host rlike 'spam|pills|adult'")
        .unionByName(entry(F.col("host"), report, shift(added), "add", "first % 4 = 1 or first % 3 = 0"))
        .unionByName(entry(F.col("host"), report, shift(added + 10 + F.col("n") % 60), "drop", "first % 4 = 1"))
        .unionByName(entry(F.col("host"), report, shift(added + 80), "add", "first % 8 = 1"))
        .unionByName(entry(domain, report, shift(added + 5), "add", "first % 5 = 2"))
    )


def op5_url_filters(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url").withColumn("fetched", _fetched())
    judged = url_filters.judge(pages, _list_entries(pages))
    return judged.select("page_id", "url", "host", "fetched", "listed", "categories", "blocked")


def op6_decontamination(spark, sf_dir):
    scanned = decontamination.scan(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return scanned.select(
        "doc_id",
        "n_words",
        decontamination.n_hit().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op7_html_extraction(spark, sf_dir):
    found = html_extraction.extract(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op8_pii(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.learn(docs))
    counts = [pii.count_of("base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.listed("base"), 256).alias("base_sha256"), pii.listed("spans").alias("spans")
    )


def op9_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        (toxicity.fold() == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "strongest",
    )


def op10_bpe(spark, sf_dir):
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), tokenizer_path())
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_source_divergence(spark, sf_dir):
    return source_divergence.audit(_table(spark, sf_dir, "documents"))


def op12_embedding_near_dedup(spark, sf_dir):
    return embedding_near_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def _stretched(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; a tenth of the texts, by a hash of the id, repeat some of their words to the end."""
    given = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    split = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    placed = (
        given.withColumn("words", F.when(F.col("h") % 10 == 0, split))
        .withColumn("n", F.size("words"))
        .withColumn("g", F.floor(F.col("h") / 10))
        .withColumn("a", F.when(F.col("n") > 0, F.expr("cast(g % n as int)")))
        .withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    )
    longer = F.expr(
        "array_join(concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), "
        "cast(1 + (n - a) div p as int))), 1, n - a)), ' ')"
    )
    return placed.select("doc_id", F.when(F.col("n") > 0, longer).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs.detect(_stretched(_table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    start, length, period = -longest["col2"], longest["length"], -longest["col3"]
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_lm_scoring,
        op3_quality_rules,
        op4_minhash,
        op5_url_filters,
        op6_decontamination,
        op7_html_extraction,
        op8_pii,
        op9_toxicity,
        op10_bpe,
        op11_source_divergence,
        op12_embedding_near_dedup,
        op13_periodic_runs,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM docs WHERE len(words) >= 13),
keyed AS (SELECT doc_id, pos, array_to_string(words[pos:pos + 12], ' ') AS window_text FROM windows),
firsts AS (SELECT window_text, min(doc_id) AS first_doc FROM keyed GROUP BY window_text),
covered AS (
  SELECT DISTINCT doc_id, pos + d AS place
  FROM keyed JOIN firsts USING (window_text) CROSS JOIN (SELECT unnest(range(13)) AS d)
  WHERE first_doc < doc_id),
gone AS (SELECT doc_id, list(place) AS places FROM covered GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(words, lambda w, i: places IS NULL OR NOT list_contains(places, i)), ' '))
         AS kept_sha256
FROM docs LEFT JOIN gone USING (doc_id)
""",
    "op6_decontamination": r"""
WITH lowered AS (
  SELECT 'd' AS kind, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
listed AS (
  SELECT kind, id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM lowered),
item_windows AS (
  SELECT id, words, least(10, len(words)) AS size, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS pos
  FROM listed WHERE kind = 'b' AND len(words) > 0),
items AS (SELECT DISTINCT id, size, array_to_string(words[pos:pos + size - 1], ' ') AS window_text FROM item_windows),
doc_windows AS (
  SELECT id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
  FROM listed, (SELECT DISTINCT size FROM items) WHERE kind = 'd' AND len(words) >= size),
hits AS (
  SELECT d.id, d.pos, d.size, i.id AS item
  FROM (SELECT id, pos, size, array_to_string(words[pos:pos + size - 1], ' ') AS window_text FROM doc_windows) d
  JOIN items i ON i.size = d.size AND i.window_text = d.window_text),
places AS (
  SELECT id, count(DISTINCT place) AS n FROM (SELECT id, unnest(range(pos, pos + size)) AS place FROM hits) GROUP BY id),
found AS (SELECT id, list_sort(list(DISTINCT CAST(item AS VARCHAR))) AS names FROM hits GROUP BY id)
SELECT l.id AS doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(names), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(names, ','), '')) AS items_sha256, n IS NOT NULL AS contaminated
FROM listed l LEFT JOIN places p ON p.id = l.id LEFT JOIN found f ON f.id = l.id WHERE kind = 'd'
""",
    "op5_url_filters": r"""
WITH captures AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 360 AS INTEGER) AS fetched,
         nullif(regexp_replace(regexp_replace(
           regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''),
           '\.?(:[0-9]*)?$', ''), '') AS host
  FROM pages),
hosts AS (SELECT host, min(page_id) AS first, count(*) AS n FROM captures WHERE host IS NOT NULL GROUP BY host),
named AS (
  SELECT *, regexp_replace(host, '^(www|m|blog)\.', '') AS domain, DATE '2024-01-01' AS start,
         CASE WHEN first % 2 = 0 THEN 'report' ELSE 'phishing' END AS report FROM hosts),
entries AS (
  SELECT domain, regexp_extract(host, '(spam|pills|adult)', 1) AS category, start + 20 AS day, 'add' AS action
  FROM named WHERE regexp_matches(host, 'spam|pills|adult')
  UNION ALL SELECT host, report, start + CAST(first % 300 AS INTEGER), 'add' FROM named
  WHERE first % 4 = 1 OR first % 3 = 0
  UNION ALL SELECT host, report, start + CAST(first % 300 + 10 + n % 60 AS INTEGER), 'drop' FROM named
  WHERE first % 4 = 1
  UNION ALL SELECT host, report, start + CAST(first % 300 + 80 AS INTEGER), 'add' FROM named WHERE first % 8 = 1
  UNION ALL SELECT domain, report, start + CAST(first % 300 + 5 AS INTEGER), 'add' FROM named WHERE first % 5 = 2),
days AS (SELECT domain, category, day, max(action) AS action FROM entries GROUP BY ALL),
valid AS (
  SELECT domain, category, action, day AS since,
         lead(day) OVER (PARTITION BY domain, category ORDER BY day) AS until FROM days),
hits AS (
  SELECT c.page_id, v.domain, v.category
  FROM captures c JOIN valid v
    ON (c.host = v.domain OR ends_with(c.host, '.' || v.domain)) AND contains(v.domain, '.')
   AND c.fetched >= v.since AND (v.until IS NULL OR c.fetched < v.until)
  WHERE v.action = 'add'),
verdicts AS (
  SELECT page_id, max_by(domain, length(domain)) AS listed,
         array_to_string(list_sort(list_distinct(list(category))), ',') AS categories
  FROM hits GROUP BY page_id)
SELECT c.page_id, c.url, c.host, c.fetched, coalesce(v.listed, '') AS listed,
       coalesce(v.categories, '') AS categories, v.listed IS NOT NULL AS blocked
FROM captures c LEFT JOIN verdicts v USING (page_id)
""",
    "op11_source_divergence": r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
used AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM used GROUP BY ALL),
common AS (SELECT lang, term FROM used GROUP BY ALL HAVING count(DISTINCT id) >= 30),
named AS (SELECT DISTINCT lang, source FROM docs),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM named g JOIN common k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
summed AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, term) AS lang_n, sum(n) OVER (PARTITION BY lang, source) AS total,
         sum(n) OVER (PARTITION BY lang) AS lang_total, count(*) OVER (PARTITION BY lang, source) AS v FROM grid),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (total + 5 * v) AS p,
         1 + (1000000000 * (lang_n + 5)) // (lang_total + 5 * v) AS q FROM summed),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(d.value, 0) AS BIGINT) AS value
  FROM named a JOIN named b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
""",
}
