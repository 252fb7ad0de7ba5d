"""URL filtering by a temporal list join.

A list is a log of dated entries: a domain is added to a category or dropped from it.  Entries
become validity intervals, and every capture is judged by the entries that were active when it
was fetched, for its host and all domains above it.  Captures are first reduced to distinct
hosts and days, so a host with a third of all captures costs one row a day; the join is an
equality of domains with a range of days.  Of the domains above a host only those are looked up
that have as many labels as some listed domain, however many labels the host has.  Everything runs as DataFrame functions.

Defined results: a null or hostless url and a null fetch day match nothing; an entry with a null
domain, day or category is ignored; if a domain is added and dropped on one day, it is dropped;
an entry holds from its own day on; repeated captures and entries change nothing.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: F.Column) -> F.Column:
    """Lower-case host without user, port and final dot; null if there is none."""
    place = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(place, r"^.*@", ""), r"\.?(:[0-9]*)?$", "")
    return F.when(host != "", host)


def depths_of(entries: DataFrame) -> list[int]:
    """How many labels the listed domains have, each number once.

    A list with n such numbers has n * n / 2 labels at least, so they are few however long it is.
    """
    size = F.size(F.split("domain", r"\."))
    return sorted(r[0] for r in entries.where("domain IS NOT NULL").select(size).distinct().collect())


def domains_of(host: F.Column, depths: list[int]) -> F.Column:
    """The host and the domains above it that have two labels or more and as many as a listed one."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    fitting = F.filter(F.lit(depths), lambda d: (d <= n) & ((d > 1) | (n == 1)))
    return F.when(host.isNotNull(), F.transform(fitting, lambda d: F.array_join(F.slice(labels, -d, d), ".")))


def intervals(entries: DataFrame) -> DataFrame:
    """``domain, category, since, until`` from ``domain, category, day, action`` (add or drop).

    ``until`` is exclusive and null while the entry is active.  Days are distinct per domain and
    category before they are ordered, so the ordered groups are as long as the list has days.
    """
    days = (
        entries.where(F.col("action").isin("add", "drop"))
        .dropna(subset=["domain", "category", "day"])
        .groupBy(F.lower("domain").alias("domain"), "category", "day")
        .agg(F.max("action").alias("action"))
    )
    next_day = F.lead("day").over(Window.partitionBy("domain", "category").orderBy("day"))
    return (
        days.withColumn("until", next_day)
        .where("action = 'add'")
        .select("domain", "category", F.col("day").alias("since"), "until")
    )


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (``url, fetched`` and others) with ``host, listed, categories, blocked``.

    ``listed`` is the most specific listed domain, ``categories`` the active ones in order,
    joined by commas; both are empty where nothing is active.  Columns of these names are
    replaced.
    """
    captures = captures.withColumn("host", host_of(F.col("url")))
    visits = captures.select("host", "fetched").dropna().distinct()
    depths = depths_of(entries) or [1]
    names = visits.withColumn("domain", F.explode(domains_of(F.col("host"), depths)))
    active = intervals(entries)
    hits = names.join(
        active,
        (names["domain"] == active["domain"])
        & (names["fetched"] >= active["since"])
        & (active["until"].isNull() | (names["fetched"] < active["until"])),
    ).select("host", "fetched", names["domain"], "category")
    verdicts = hits.groupBy("host", "fetched").agg(
        F.max_by("domain", F.length("domain")).alias("listed"),
        F.array_join(F.sort_array(F.collect_set("category")), ",").alias("categories"),
    )
    judged = captures.drop("listed", "categories", "blocked").join(verdicts, ["host", "fetched"], "left")
    return judged.withColumns(
        {
            "blocked": F.col("listed").isNotNull(),
            "listed": F.coalesce("listed", F.lit("")),
            "categories": F.coalesce("categories", F.lit("")),
        }
    )
