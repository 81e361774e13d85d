"""Ordered drop rules. The first rule that fires names the reason."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siftwell.functions.bind import let
from siftwell.functions.dates import older_than
from siftwell.schema import FilterRules, as_lit

# The reasons, in rule order.
DROP_REASONS = ["no-keyword", "excluded-keyword", "blocked-location", "location-not-allowed", "stale"]


# Up to so many needles are looked for one by one; that is cheaper than a pattern.
FEW_NEEDLES = 12
# A branch with more ways out is halved by a look at the next character.
FEW_WAYS = 4


def _trie(needles: Iterable[str]) -> dict:
    """Needles letter by letter; one that begins with a shorter needle adds nothing."""
    root: dict = {}
    for needle in sorted(needles):
        node = root
        for c in needle:
            if "" in node:
                break
            node = node.setdefault(c, {})
        else:
            node.clear()
            node[""] = {}
    return root


def _pattern(node: dict) -> str:
    """The trie as a regex that decides on one character at a time, without going back."""
    prefix = ""
    while len(node) == 1 and "" not in node:
        [(c, node)] = node.items()
        prefix += re.escape(c)
    if "" in node:
        return prefix
    return prefix + _branch(sorted(node.items()))


def _branch(ways: list[tuple[str, dict]]) -> str:
    if len(ways) <= FEW_WAYS:
        return "(?:" + "|".join(re.escape(c) + _pattern(below) for c, below in ways) + ")"
    half = len(ways) // 2
    first, last = re.escape(ways[0][0]), re.escape(ways[half - 1][0])
    return f"(?:(?=[{first}-{last}]){_branch(ways[:half])}|(?![{first}-{last}]){_branch(ways[half:])})"


def any_of(needles: list[str]) -> str:
    """One pattern that finds any of the needles in a single pass over a text."""
    return _pattern(_trie(needles))


def contains_any(text: Column, needles: list[str]) -> Column:
    """True if any needle is a substring; whole words are not required.

    Many needles become one pattern made of their trie, so their number costs little; the text is
    computed once either way.
    """
    lowered = list(dict.fromkeys(n.lower() for n in needles))
    if not lowered:
        return F.lit(False)
    if len(lowered) <= FEW_NEEDLES or "" in lowered:
        return let(text, lambda t: reduce(or_, [F.contains(t, F.lit(n)) for n in lowered]))
    return F.rlike(text, F.lit(any_of(lowered)))


def drop_reason(rules: FilterRules, now: datetime | Column) -> Column:
    """NULL for a posting that stays, else the reason it goes.

    Unknown is not no: an empty location and an unknown date both pass.
    """
    title = F.lower(F.coalesce(F.col("title"), F.lit("")))
    tags = F.lower(F.concat_ws(" ", F.coalesce(F.col("tags"), F.array().cast("array<string>"))))
    location = F.lower(F.coalesce(F.col("location"), F.lit("")))
    fires = [
        ~contains_any(F.concat(title, F.lit(" "), tags), rules.keywords),
        contains_any(title, rules.exclude_keywords),
        contains_any(location, rules.location_block),
        (location != "") & ~contains_any(location, rules.location_allow),
        older_than(F.col("posted_at"), as_lit(now), rules.max_age_days),
    ]
    out = F.when(fires[0], F.lit(DROP_REASONS[0]))
    for test, reason in zip(fires[1:], DROP_REASONS[1:]):
        out = out.when(test, F.lit(reason))
    return out


def with_drop_reason(postings: DataFrame, rules: FilterRules, now: datetime | Column) -> DataFrame:
    return postings.withColumn("drop_reason", drop_reason(rules, now))


def kept(marked: DataFrame) -> DataFrame:
    return marked.where(F.col("drop_reason").isNull()).drop("drop_reason")


def dropped(marked: DataFrame) -> DataFrame:
    return marked.where(F.col("drop_reason").isNotNull())


def drop_counts(marked: DataFrame) -> DataFrame:
    """Rows removed per reason, with a zero for each reason that never fired."""
    spark = marked.sparkSession
    reasons = spark.createDataFrame([(r, i) for i, r in enumerate(DROP_REASONS)], "drop_reason string, rule int")
    counts = dropped(marked).groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))
    # One row per reason: five at most.
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")
    return reasons.join(F.broadcast(counts), "drop_reason", "left").select("drop_reason", "rule", n)


def observe_reasons(marked: DataFrame) -> tuple[DataFrame, Observation]:
    """``marked`` with counters that are filled while it is written: ``fetched``,
    ``after_prefilter``, and one per reason.

    Each counter is right if the rows are written without a shuffle after this point, since only
    finished tasks of a job's last stage count once.
    """
    counters = Observation()
    per_reason = [F.count_if(F.col("drop_reason") == r).alias(r) for r in DROP_REASONS]
    passed = F.count_if(F.col("drop_reason").isNull()).alias("after_prefilter")
    return marked.observe(counters, F.count(F.lit(1)).alias("fetched"), passed, *per_reason), counters


def eligible_only(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("classification.eligible"))


def confidence_band(review_below: float) -> Column:
    """``confident`` at or above the bound, ``review`` below it."""
    return F.when(F.col("classification.confidence") >= F.lit(review_below), F.lit("confident")).otherwise(F.lit("review"))
