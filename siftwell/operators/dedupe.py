"""Order-sensitive dedupe on two keys.

Reading postings in order, a posting is dropped when its url key or its company-and-title
key was registered by a posting that was *kept*; dropped postings register nothing. That is
a greedy matching between url keys and title keys, which neither a window per key nor
connected components gives.

It runs in rounds over narrow ``(url key, title key, order)`` rows. A posting that comes first
among the undecided rows of both its keys is kept for certain. One that comes first for one key
and second for the other depends on a single earlier posting: it is kept if that one is not. Such
dependencies form chains, which are followed by pointer doubling, so a chain of n links settles in
log2(n) joins within one round. Whatever shares a key with a kept posting is dropped, and the rest
goes on to the next round; every round keeps at least the earliest undecided posting.

A round costs several jobs, however few rows are left; once there are at most ``FEW`` of them, the
driver reads those narrow rows in order and settles them as described above.

All of it is joins and first-two-per-key windows, which Spark limits to two rows per key and task
before the shuffle. A hot key is a skewed join key, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from siftwell.functions.text import normalise_company, normalise_title
from siftwell.functions.urls import canonical_url
from siftwell.operators.distinct import top_per_key
from siftwell.runtime import cut_lineage


# So many undecided rows, of two keys and a number, are settled by the driver.
FEW = 10_000


def with_dedupe_keys(postings: DataFrame) -> DataFrame:
    """Add ``url_key`` and ``title_key``."""
    return postings.withColumn("url_key", canonical_url(F.col("url"))).withColumn(
        "title_key", F.concat_ws("|", normalise_company(F.col("company")), normalise_title(F.col("title")))
    )


def _first_two(rows: DataFrame, key: str, nth: str, before: str) -> DataFrame:
    """The two earliest rows per key with their rank, and the order of the row before."""
    top = top_per_key(rows, [key], [F.col("ord")], 2, nth)
    return top.withColumn(before, F.lag("ord").over(Window.partitionBy(key).orderBy("ord")))


def _chain_ends(links: DataFrame) -> DataFrame:
    """``links`` (``ord``, ``target``, ``odd``) followed to the first target that links no further."""
    while True:
        onward = links.select(F.col("ord").alias("target"), F.col("target").alias("next"), F.col("odd").alias("flip"))
        followed = links.join(onward, "target", "left").select(
            "ord",
            F.coalesce("next", "target").alias("target"),
            (F.col("odd") != F.coalesce("flip", F.lit(False))).alias("odd"),
            F.col("next").isNotNull().alias("moved"),
        )
        moved = Observation()
        links = cut_lineage(followed.observe(moved, F.count_if("moved").alias("n"))).drop("moved")
        if not moved.get["n"]:
            return links


def _winners(undecided: DataFrame) -> DataFrame:
    """Rows that are kept for certain: (``url_key``, ``title_key``, ``ord``)."""
    by_url = _first_two(undecided, "url_key", "_u", "_url_before")
    by_title = _first_two(undecided, "title_key", "_t", "_title_before").select("ord", "_t", "_title_before")
    placed = cut_lineage(by_url.join(by_title, "ord"))
    first = (F.col("_u") == 1) & (F.col("_t") == 1)
    roots = placed.where(first)
    # Second for one key only: at most one earlier row can speak against it.
    single = placed.where(F.col("_u") + F.col("_t") == 3)
    links = single.select(
        "ord", F.coalesce("_url_before", "_title_before").alias("target"), F.lit(True).alias("odd")
    )
    ends = _chain_ends(links).where(~F.col("odd"))
    settled = ends.join(roots.select(F.col("ord").alias("target")), "target", "left_semi").select("ord")
    kept = roots.select("ord").unionByName(settled)
    return placed.join(kept, "ord", "left_semi").select("url_key", "title_key", "ord")


def kept_orders(keyed: DataFrame, order: str = "ord") -> DataFrame:
    """Orders of the kept postings, from ``url_key``, ``title_key`` and a unique BIGINT order."""
    # A posting that repeats both keys of an earlier one is always dropped: if the earlier one
    # was kept it blocks, and if not, whatever blocked it blocks this one too.
    undecided, n = _cut_and_count(keyed.groupBy("url_key", "title_key").agg(F.min(order).alias("ord")))
    kept = undecided.select("ord").limit(0)
    while n > FEW:
        winners = cut_lineage(_winners(undecided))
        kept = kept.unionByName(winners.select("ord"))
        rest = undecided.join(winners.select("url_key"), "url_key", "left_anti")
        undecided, n = _cut_and_count(rest.join(winners.select("title_key"), "title_key", "left_anti"))
    if n:
        kept = kept.unionByName(_settle_few(undecided))
    return kept.select(F.col("ord").alias(order))


def _cut_and_count(rows: DataFrame) -> tuple[DataFrame, int]:
    counter = Observation()
    return cut_lineage(rows.observe(counter, F.count(F.lit(1)).alias("n"))), counter.get["n"]


def _settle_few(undecided: DataFrame) -> DataFrame:
    """Orders kept among at most ``FEW`` rows, read one after another."""
    urls, titles, kept = set(), set(), []
    for row in undecided.orderBy("ord").collect():
        if row["url_key"] not in urls and row["title_key"] not in titles:
            urls.add(row["url_key"])
            titles.add(row["title_key"])
            kept.append((row["ord"],))
    return undecided.sparkSession.createDataFrame(kept, "ord bigint")


def dedupe(postings: DataFrame, order: str = "ord", strict_empty: bool = False) -> DataFrame:
    """Kept postings. ``postings`` needs url, company, title and a unique BIGINT ``order``.

    All empty urls share one key, and so do titles without a Latin letter at one company.
    ``strict_empty`` leaves such keys out of the comparison.
    """
    keyed = with_dedupe_keys(postings)
    narrow = keyed.select("url_key", "title_key", order)
    if strict_empty:
        own = F.concat(F.lit("\u0000"), F.col(order).cast("string"))
        narrow = narrow.withColumn("url_key", F.when(F.col("url_key") == "", own).otherwise(F.col("url_key")))
        narrow = narrow.withColumn(
            "title_key", F.when(F.endswith("title_key", F.lit("|")), own).otherwise(F.col("title_key"))
        )
    kept = kept_orders(narrow, order)
    # Both sides hold each order once, so this join has no hot key.
    return postings.join(kept, order, "left_semi")
