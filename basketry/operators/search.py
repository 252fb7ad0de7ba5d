"""Regular expressions on product names through an index of letter triples.

The index is a table of (triple, product), range-clustered, so that a triple of many products
spreads over files and a lookup skips the rest by parquet's minima and maxima.  A pattern's
literal stretches say which triples a match must have; products with the rarest of them are
candidates, and only these meet the pattern itself.  Patterns that promise no triple, or use
syntax that isn't read here, scan all products.
"""

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import settings
from basketry.operators import serving

TRIPLE = 3
# Flags, look-around, quoting, back references and escapes that take arguments.
_UNREAD = re.compile(r"\(\?|\\[^\W_bBdDsSwWhHvVRAzZGnrtfae]")
_PIECE = re.compile(
    r"(?P<escape>\\.)|(?P<set>\[\^?(?:\\.|[^\\\[\]])+\])|(?P<often>(?:[?*+]|\{[^}]*\})[?+]?)"
    r"|(?P<mark>[()|.^$\[{])|(?P<plain>.)",
    re.DOTALL,
)


def literal_stretches(pattern: str) -> list[list[str]] | None:
    """For each top-level alternative, texts that all its matches contain; None where unread."""
    if _UNREAD.search(pattern):
        return None
    alternatives, stretch, depth = [[""]], "", 0
    for piece in _PIECE.finditer(pattern):
        kind, text = piece.lastgroup, piece[0]
        if text in ("[", "{") or text == "\\":
            return None
        depth += (text == "(") - (text == ")")
        if depth < 0:
            return None
        if kind == "plain" or (kind == "escape" and not text[1].isalnum()):
            stretch += text[-1] if depth == 0 else ""
            continue
        if kind == "often" and text[0] != "+":
            stretch = stretch[:-1]
        alternatives[-1].append(stretch)
        stretch = ""
        if text == "|" and depth == 0:
            alternatives.append([])
    alternatives[-1].append(stretch)
    return alternatives if depth == 0 else None


def required_triples(pattern: str) -> list[set[str]] | None:
    """Triples each alternative needs; None where one of them needs none."""
    alternatives = literal_stretches(pattern)
    if alternatives is None:
        return None
    needed = [
        {s[i : i + TRIPLE] for s in stretches for i in range(len(s) - TRIPLE + 1)}
        for stretches in alternatives
    ]
    return needed if all(needed) else None


def postings(products: DataFrame) -> DataFrame:
    """``triple, productId``, once for each product that has the triple in its name."""
    places = F.sequence(F.lit(1), F.length("name") - (TRIPLE - 1))
    triples = F.array_distinct(F.transform(places, lambda i: F.substr("name", i, F.lit(TRIPLE))))
    named = products.where(F.length("name") >= TRIPLE)
    return named.select(F.explode(triples).alias("triple"), "productId").distinct()


def posting_counts(posted: DataFrame) -> DataFrame:
    return posted.groupBy("triple").agg(F.count("*").alias("count"))


def candidates(posted: DataFrame, counts: DataFrame, pattern: str) -> DataFrame | None:
    """``productId`` of products that may match; None where the pattern needs a scan.

    Of each alternative the rarest triples are looked up; the counts that come to the driver are
    as many as the pattern has triples.
    """
    needed = required_triples(pattern)
    if needed is None:
        return None
    known = dict(counts.where(F.col("triple").isin(*set().union(*needed))).select("triple", "count").collect())
    chosen = [
        sorted(triples, key=lambda t: (known[t], t))[: settings.SEARCH_TRIPLES]
        for triples in needed
        if triples <= known.keys()
    ]
    found = posted.where(F.col("triple").isin(*{t for some in chosen for t in some}))
    if not chosen:
        return found.select("productId")
    held = F.collect_set("triple")
    has = [reduce(and_, [F.array_contains("held", t) for t in some]) for some in chosen]
    return found.groupBy("productId").agg(held.alias("held")).where(reduce(or_, has)).select("productId")


def matching(products: DataFrame, posted: DataFrame, counts: DataFrame, pattern: str) -> DataFrame:
    """Products whose name has a match of ``pattern``, as a scan of all of them would find."""
    likely = candidates(posted, counts, pattern)
    if likely is not None:
        likely = likely.withColumnRenamed("productId", "likely")
        products = products.join(likely, products["productId"].eqNullSafe(likely["likely"]), "left_semi")
    return products.where(F.col("name").rlike(pattern))


def search_products(products, averages, posted, counts, pattern: str) -> DataFrame:
    """``serving.search_products`` by the index."""
    return serving.with_average(matching(products, posted, counts, pattern), averages)
