"""How far the sources of each language differ in the terms they use.

Equal texts of a language are collapsed first: a digest names them, a small table counts them
by source, and the text itself is carried once and cut into terms once.  Its terms then count
for every source that has it, times the copies there, and its copies count as documents.  Terms
in enough documents of the language are kept.  A group, a language's source, gives each kept
term a smoothed share in billionths, in exact whole numbers.

Two groups differ by the sum of the absolute differences of their shares.  Most terms are
missing in most groups, where a share is the group's least one, so only the terms that a group
has are looked at: they are cut into chunks by hash, groups into blocks, and a task adds up one
chunk for the pairs of two blocks.  What all other terms add is a product.

Defined results: a null text, language or source counts as empty; repeated rows count each; a
language without kept terms has pairs of value 0 and no terms; a group without terms, or without
kept ones, takes part with the least share; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry import shared
from basketry.llm import words

shared.ship(__name__)

MIN_DOCS = 30
TOP_TERMS = 50
#: Added to every count.
SMOOTHING = 5
#: Shares are counted in parts of this size, rounded down, plus one.
PARTS = 1_000_000_000
#: Groups of a block, about, and counted terms of a task.
BLOCK = 128
CHUNK_ROWS = 200_000
#: Counts made at once, and terms looked at together.
_AT_ONCE = 1 << 20
_WIDTH = 2048

#: [^\x00-\x40\x5B-\x60\x7B-\x7F]+ of text whose A-Z are lower-cased
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], [np.add.reduceat(v[order], starts) for v in values]


def term_codes(got: words.Words) -> tuple[np.ndarray, pa.Array]:
    """A number for every word, and the words that the numbers stand for."""
    letters = got.data[LETTERS[got.data]]
    ends = np.concatenate([[0], np.cumsum(got.ends - got.starts)]).astype(np.int32)
    every = pa.Array.from_buffers(pa.string(), len(got), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    coded = every.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def _count(langs: pa.Array, texts: list, copies: pa.Array):
    """Batches ``lang, source, term, n, docs`` of some texts, each with its copies by source."""
    got = words.Words(texts, LETTERS, lower=True)
    if not len(got):
        return
    codes, terms = term_codes(got)
    found, [times] = _sums(got.text_of * len(terms) + codes, np.ones(len(got), np.int64))
    text, code = np.divmod(found, len(terms))

    langs, sources = langs.dictionary_encode(), copies.flatten().field("source").dictionary_encode()
    number = copies.flatten().field("n").to_numpy()
    size = np.diff(copies.offsets.to_numpy())
    first = np.cumsum(size) - size
    group = np.repeat(langs.indices.to_numpy().astype(np.int64), size) * len(sources.dictionary) + sources.indices.to_numpy()

    # A text of many sources makes many counts of a term, so go on by the number made.
    made = np.cumsum(size[text])
    start = 0
    while start < len(text):
        done = made[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(made, done + _AT_ONCE, "right")))
        each = size[text[start:end]]
        row = np.repeat(np.arange(start, end), each)
        copy = first[text[row]] + np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
        keys, [n, docs] = _sums(group[copy] * len(terms) + code[row], times[row] * number[copy], number[copy])
        lang, source = np.divmod(keys // len(terms), len(sources.dictionary))
        yield pa.RecordBatch.from_arrays(
            [
                langs.dictionary.take(pa.array(lang)),
                sources.dictionary.take(pa.array(source)),
                terms.take(pa.array(keys % len(terms))),
                pa.array(n),
                pa.array(docs),
            ],
            ["lang", "source", "term", "n", "docs"],
        )
        start = end


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents with the term, of ``lang, source, text``."""
    named = docs.withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = (
        named.groupBy("lang", "digest", "source")
        .agg(F.count("*").alias("n"))
        .groupBy("lang", "digest")
        .agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    )
    once = named.groupBy("lang", "digest").agg(F.first("text").alias("text"))

    def run(batches):
        for batch in batches:
            texts = words.binary(batch.column(1))
            for start, end in words.text_slices(texts):
                own = batch.slice(start, end - start)
                yield from _count(own.column(0), texts[start:end], own.column(2))

    return (
        once.join(copies, ["lang", "digest"])
        .select("lang", "text", "copies")
        .mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def share(count: str, total: str) -> F.Column:
    """Smoothed share of ``count`` in ``total``, beside the number of terms ``v`` of the language."""
    return F.expr(
        f"1L + ({PARTS} * (cast({count} as decimal(20,0)) + {SMOOTHING})) div "
        f"(case when v = 0 then 1 else cast({total} as decimal(20,0)) + {SMOOTHING} * cast(v as decimal(20,0)) end)"
    )


def _differences(table: pa.Table, blocks: tuple[int, int], chunk: int) -> pa.Table:
    """What the counted terms of one chunk add to the differences between the groups of two blocks."""
    is_group = np.asarray(table["term"].is_null())
    groups = table.filter(pa.array(is_group))
    names = groups["source"].combine_chunks()
    order = {name: i for i, name in enumerate(names.to_pylist())}
    least, block = groups["p"].to_numpy(), groups["block"].to_numpy()
    apart = np.abs(least[:, None] - least[None, :])

    counted = table.filter(pa.array(~is_group))
    term = counted["term"].combine_chunks().dictionary_encode().indices.to_numpy()
    source = np.array([order[s] for s in counted["source"].to_pylist()], np.int64)
    p = counted["p"].to_numpy()
    rows = np.lexsort((source, term // _WIDTH))
    term, source, p = term[rows], source[rows], p[rows]

    whole = np.zeros((len(names), len(names)), np.int64)
    alone = np.zeros_like(whole)
    side = [np.flatnonzero(block == b) for b in blocks]
    others = [side[1] if b == blocks[0] else side[0] for b in block.tolist()]
    cuts = np.flatnonzero(np.diff(term // _WIDTH, prepend=-1)).tolist()
    for start, end in zip(cuts, [*cuts[1:], len(term)], strict=False):
        at = term[start:end] % _WIDTH
        shares = np.repeat(least[:, None], _WIDTH, axis=1)
        shares[source[start:end], at] = p[start:end]
        has = np.zeros(shares.shape, bool)
        has[source[start:end], at] = True
        edges = np.flatnonzero(np.diff(source[start:end], prepend=-1)).tolist()
        for s, e in zip(edges, [*edges[1:], end - start], strict=True):
            a = int(source[start + s])
            near = np.ix_(others[a], at[s:e])
            more = np.abs(p[start + s : start + e] - shares[near]) - apart[a, others[a]][:, None]
            whole[a, others[a]] += more.sum(1)
            alone[a, others[a]] += np.where(has[near], 0, more).sum(1)
    values = whole + alone.T
    if chunk == 0:
        values += apart * groups["v"].to_numpy()[:, None]
    a, b = np.nonzero((block[:, None] == blocks[0]) & (block[None, :] == blocks[1]))
    a, b = a[a != b], b[a != b]
    if blocks[0] != blocks[1]:
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
    return pa.table(
        {
            "lang": table["lang"].combine_chunks().take(pa.array(np.zeros(len(a), np.int64))),
            "source": names.take(pa.array(a)),
            "item": names.take(pa.array(b)),
            "value": pa.array(values[a, b]),
        }
    )


def pair_values(groups: DataFrame, terms: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every two groups of a language.

    ``groups`` has ``lang, source, total, v``, ``terms`` has ``lang, source, term, p``, and both
    have the numbers of ``blocks`` and ``chunks`` of the language.
    """
    own = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("block")
    columns = ["lang", "source", "term", "p", "v", "block", "blocks", "chunk"]
    given = terms.select(
        "*", F.lit(None).cast("bigint").alias("v"), own, F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int").alias("chunk")
    )
    every = groups.select(
        "*",
        F.lit(None).cast("string").alias("term"),
        share("0", "total").alias("p"),
        own,
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
    )
    met = (
        given.select(columns)
        .unionByName(every.select(columns))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*columns, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    )

    def run(key, table):
        return _differences(table, (key[1].as_py(), key[2].as_py()), key[3].as_py())

    return (
        met.groupBy("lang", "i", "j", "chunk")
        .applyInArrow(run, "lang string, source string, item string, value bigint")
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )


def audit(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    block: int = BLOCK,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair`` has the differences to all other sources of the language, part ``term`` the
    terms that a group uses more than its language does, the first ``top_terms`` of them.
    """
    docs = docs.select(
        *[
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
            for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
        ]
    )
    by_term = Window.partitionBy("lang", "term")
    kept = shared.stage(
        term_counts(docs)
        .select(
            "lang",
            "source",
            "term",
            "n",
            F.sum("n").over(by_term).alias("lang_n"),
            F.sum("docs").over(by_term).alias("all_docs"),
            (F.min("source").over(by_term) == F.col("source")).alias("first"),
        )
        .where(F.col("all_docs") >= min_docs)
        .drop("all_docs"),
        "kept-terms",
    )
    totals = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count("*").alias("rows"), F.count_if("first").alias("firsts")
    )
    by_lang = Window.partitionBy("lang")

    def tasks(number, each):
        return F.greatest(F.ceil(number / each), F.lit(1)).cast("int")

    groups = shared.stage(
        docs.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .na.fill(0, ["total", "rows", "firsts"])
        .select(
            "lang",
            "source",
            "total",
            F.sum("total").over(by_lang).alias("lang_total"),
            F.sum("firsts").over(by_lang).alias("v"),
            tasks(F.count("*").over(by_lang), block).alias("blocks"),
            tasks(F.sum("rows").over(by_lang), chunk_rows).alias("chunks"),
        ),
        "groups",
    )
    shares = shared.stage(
        kept.join(groups, ["lang", "source"]).select(
            "lang",
            "source",
            "term",
            share("n", "total").alias("p"),
            share("lang_n", "lang_total").alias("q"),
            "blocks",
            "chunks",
        ),
        "shares",
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(groups, shares.drop("q")).withColumn("rank", F.row_number().over(by_value))
    terms = (
        shares.where("p > q")
        .select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
        .where(F.col("rank") <= top_terms)
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair"))
        .select(columns)
        .unionByName(terms.withColumn("part", F.lit("term")).select(columns))
    )
