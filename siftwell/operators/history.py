"""First-seen state across runs: an append-only table of (url, first_seen)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.dates import age_in_days, first_seen_stamp
from siftwell.schema import as_lit


def unseen(postings: DataFrame, history: DataFrame, now: datetime | Column) -> DataFrame:
    """History rows to append for urls never seen before.

    Urls are made distinct first (combined map-side), so the anti join has one row per url.
    """
    urls = postings.select("url").where(F.coalesce(F.col("url"), F.lit("")) != "").distinct()
    return urls.join(history.select("url"), "url", "left_anti").withColumn("first_seen", first_seen_stamp(as_lit(now)))


def update_first_seen(postings: DataFrame, history: DataFrame, now: datetime | Column) -> DataFrame:
    """The whole history after a run. Known dates are never overwritten and never expire."""
    return first_sightings(history).unionByName(unseen(postings, history, now))


def new_count(postings: DataFrame, history: DataFrame, now: datetime | Column) -> DataFrame:
    return unseen(postings, history, now).agg(F.count(F.lit(1)).alias("new_since_last_run"))


def first_sightings(history: DataFrame) -> DataFrame:
    """One row per url with its earliest date, however often the history names it."""
    return history.groupBy("url").agg(F.min("first_seen").alias("first_seen"))


def mark_new(postings: DataFrame, history: DataFrame) -> DataFrame:
    """Add ``first_seen`` and ``is_new`` against the history as it was before this run.

    The history side holds a url once; postings may repeat one without bound, which makes a
    skewed key that adaptive execution splits.
    """
    joined = postings.join(first_sightings(history), "url", "left")
    is_new = F.col("first_seen").isNull() & (F.coalesce(F.col("url"), F.lit("")) != "")
    return joined.withColumn("is_new", is_new)


def with_age(postings: DataFrame, history: DataFrame, now: datetime | Column) -> DataFrame:
    """Add ``age_days``: whole days since the first sighting, NULL for a url not in the history."""
    joined = postings.join(first_sightings(history), "url", "left")
    return joined.withColumn("age_days", age_in_days(F.col("first_seen"), as_lit(now)))
