"""Which scored postings to act on today, and how many."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.dates import older_than, younger_than
from siftwell.functions.text import company_key
from siftwell.operators.distinct import top_per_key
from siftwell.operators.history import first_sightings
from siftwell.operators.ledger import submitted_on
from siftwell.operators.ordering import budgeted_take, first_n_flag, newest_first, newest_first_key
from siftwell.schema import SelectionRules, as_lit


def select_candidates(
    scored: DataFrame,
    ledger: DataFrame,
    history: DataFrame,
    rules: SelectionRules,
    now: datetime | Column,
    order: str = "ord",
) -> DataFrame:
    """One posting per company, newest first, that passes every gate.

    Cheap column filters run before the joins, whose other sides hold a key once. A company or a
    url may hold any share of the postings; adaptive execution splits such a key. The pick per
    company is limited map-side before its shuffle.
    """
    now = as_lit(now)
    score = F.col("classification")
    wanted = scored.where(
        F.coalesce(score["eligible"], F.lit(False))
        & (score["confidence"] >= rules.min_confidence)
        & score["employment_type"].isin(*rules.employment_types)
    ).withColumn("company_key", company_key(F.col("company")))
    excluded = {_key(name) for name in rules.exclude_companies}
    if excluded:
        wanted = wanted.where(~F.col("company_key").isin(*sorted(excluded)))

    cooling = (
        ledger.where((F.col("status") == "applied") & younger_than(F.col("at"), now, rules.company_cooldown_days))
        .select(company_key(F.col("company")).alias("company_key"))
        .distinct()
    )
    open_to = wanted.join(cooling, "company_key", "left_anti")

    previous = ledger.select(
        "url",
        F.lit(True).alias("_known"),
        ((F.col("status") == "failed") & older_than(F.col("at"), now, rules.retry_failed_after_days)).alias("_retry"),
    )
    fresh = (
        open_to.join(first_sightings(history), "url", "left")
        .join(previous, "url", "left")
        .where(~older_than(F.col("first_seen"), now, rules.max_age_days))
        .where(F.col("_known").isNull() | F.col("_retry"))
        .drop("_known", "_retry")
    )
    picked = top_per_key(fresh, ["company_key"], [F.col("posted_at").desc_nulls_last(), F.col(order).asc()])
    return newest_first(picked, order=order)


def _key(name: str) -> str:
    return "".join(ch for ch in name.lower() if ch.isascii() and ch.isalnum())


def submission_budget(ledger: DataFrame, rules: SelectionRules, day: datetime | Column) -> DataFrame:
    """One row: submissions still allowed today."""
    left = F.greatest(F.lit(0), F.lit(rules.daily_cap) - F.col("submitted"))
    return submitted_on(ledger, day).select(left.cast("bigint").alias("budget"))


def process_in_budget(
    attempts: DataFrame, budget: int, rules: SelectionRules, order: str = "ord"
) -> DataFrame:
    """Attempts that fit the budget, with ``prep``: whether a review item gets a prepared note.

    Only submissions and dry runs use the budget up; review items with a note use up the
    preparation limit.
    """
    key = newest_first_key(F.col("posted_at"), F.col(order))
    done = budgeted_take(attempts, key, F.col("status").isin("applied", "dry-run"), budget)
    noted = (F.col("status") == "review") & (F.coalesce(F.col("cover_note"), F.lit("")) != "")
    return first_n_flag(done, key, noted, rules.review_prep_limit, "prep")
