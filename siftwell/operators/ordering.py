"""Newest-first order and budgets, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.runtime import cut_lineage

# How monotonically_increasing_id packs a partition's number and a row's place in it.
_RANGE_BITS = 33
_IN_RANGE = (1 << _RANGE_BITS) - 1
LAST = (1 << 63) - 1


def newest_first(df: DataFrame, posted_at: str = "posted_at", order: str = "ord") -> DataFrame:
    """Newest first, unknown dates last, ties in arrival order. Sorts by range partitioning."""
    return df.orderBy(F.col(posted_at).desc_nulls_last(), F.col(order).asc())


def with_place(df: DataFrame, *order: Column, place: str = "place") -> DataFrame:
    """Add every row's place, from 1, in the given order.

    A distributed rank: rows are sorted by range, each range numbers its own, and the sizes of the
    ranges before are added. The sorted rows are written once, since sorting again could draw other
    ranges; the driver sees one number per range.
    """
    sorted_rows = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    sorted_rows = cut_lineage(sorted_rows)
    # The id is the range's number, shifted, plus the place in the range.
    within, part = F.col("_at").bitwiseAND(F.lit(_IN_RANGE)), F.shiftright("_at", _RANGE_BITS)
    sizes = sorted_rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, offsets = 0, []
    for row in sorted(sizes, key=lambda r: r["part"]):
        offsets.append((row["part"], before))
        before += row["n"]
    starts = df.sparkSession.createDataFrame(offsets, "_part bigint, _before bigint")
    placed = sorted_rows.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return placed.withColumn(place, F.col("_before") + within + 1).drop("_part", "_before", "_at")


def newest_first_places(df: DataFrame, posted_at: str = "posted_at", order: str = "ord") -> DataFrame:
    """Every row's ``place`` in :func:`newest_first`."""
    return with_place(df, F.col(posted_at).desc_nulls_last(), F.col(order).asc())


def newest_first_key(posted_at: Column, order: Column) -> Column:
    """Ascending sort key of :func:`newest_first` as one comparable struct."""
    age = F.coalesce(-F.unix_micros(posted_at), F.lit(LAST))
    return F.struct(age.alias("age"), order.alias("ord"))


def budgeted_take(df: DataFrame, key: Column, consumes: Column, budget: int) -> DataFrame:
    """Rows processed in ``key`` order until ``budget`` consuming rows have been processed.

    Processing stops at the row that uses up the budget, so it is enough to know that row's
    key: a top-k over the consuming rows, k being the (small, configured) budget.
    """
    if budget <= 0:
        return df.limit(0)
    keyed = df.withColumn("_key", key)
    spent = keyed.where(consumes).select("_key").orderBy("_key").limit(budget)
    last = spent.agg(F.when(F.count(F.lit(1)) >= budget, F.max("_key")).alias("last")).scalar()
    return keyed.where(F.coalesce(F.col("_key") <= last, F.lit(True))).drop("_key")


def first_n_flag(df: DataFrame, key: Column, counts: Column, n: int, flag: str) -> DataFrame:
    """``flag`` is true while fewer than ``n`` earlier rows satisfied ``counts``."""
    if n <= 0:
        return df.withColumn(flag, F.lit(False))
    keyed = df.withColumn("_key", key)
    used = keyed.where(counts).select("_key").orderBy("_key").limit(n)
    last = used.agg(F.when(F.count(F.lit(1)) >= n, F.max("_key")).alias("last")).scalar()
    return keyed.withColumn(flag, F.coalesce(F.col("_key") <= last, F.lit(True))).drop("_key")
