"""Action state: an append-only log of application records, read as the latest row per url."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.operators.distinct import first_per_key, latest_per_key
from siftwell.schema import PRIVATE_COLUMNS, as_lit

MANUAL_REASON = "applied manually"


def latest_records(log: DataFrame, order: str = "ord") -> DataFrame:
    """Current ledger: the last write per url wins."""
    return latest_per_key(log, ["url"], order)


def public_records(log: DataFrame) -> DataFrame:
    """Records without personal details, safe to share."""
    return log.drop(*PRIVATE_COLUMNS)


def private_notes(log: DataFrame, order: str = "ord") -> DataFrame:
    """Notes that hold personal details, one row per write that carries any."""
    present = F.coalesce(F.col("cover_note"), F.lit("")) != ""
    return log.where(present | F.col("answers").isNotNull()).select("url", order, *PRIVATE_COLUMNS)


def with_private_notes(ledger: DataFrame, notes: DataFrame, order: str = "ord") -> DataFrame:
    """Ledger with the last note per url merged back; notes without a ledger row are ignored."""
    last = latest_per_key(notes, ["url"], order).drop(order)
    return ledger.drop(*PRIVATE_COLUMNS).join(last, "url", "left")


def mark_done(
    ledger: DataFrame, keys: DataFrame, now: datetime | Column, order: str = "ord"
) -> tuple[DataFrame, DataFrame]:
    """Records to append for postings handled by hand, and the keys that match nothing.

    ``keys`` has one column ``key``, a posting url or a form url. A posting url wins; of several
    records with one form url the first in ledger order is taken. Two equi joins, no OR-join.
    """
    keys = keys.select("key").distinct()
    by_url = keys.join(ledger, F.col("key") == F.col("url"))
    others = keys.join(ledger.select(F.col("url").alias("key")), "key", "left_anti")
    first_by_form = first_per_key(ledger.where(F.col("apply_url").isNotNull()), ["apply_url"], order)
    by_form = others.join(first_by_form, F.col("key") == F.col("apply_url"))
    unknown = others.join(first_by_form.select(F.col("apply_url").alias("key")), "key", "left_anti")
    done = (
        by_url.unionByName(by_form)
        .drop("key")
        .dropDuplicates(["url"])
        .withColumn("status", F.lit("applied"))
        .withColumn("reason", F.lit(MANUAL_REASON))
        .withColumn("at", as_lit(now))
    )
    return done, unknown


def submitted_on(ledger: DataFrame, day: datetime | Column) -> DataFrame:
    """One row: real submissions on the UTC day of ``day``. Dry runs do not count."""
    on_day = (F.col("status") == "applied") & (F.to_date("at") == F.to_date(as_lit(day)))
    return ledger.agg(F.count_if(on_day).alias("submitted"))
