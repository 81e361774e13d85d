"""The posting schema and the settings that steer the operators."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Required text is '' when absent; salary, tags and posted_at are NULL when unknown.
POSTING = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("source_rank", T.IntegerType()),
        T.StructField("seq", T.LongType()),
        T.StructField("company", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("posted_at", T.TimestampType()),
        T.StructField("salary", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("description", T.StringType()),
    ]
)
POSTING_COLUMNS = [f.name for f in POSTING]

# Landed payloads: one fetched document per row. ``seq`` is the arrival order.
BRONZE = "source string, company string, url string, payload string, seq bigint"

CLASSIFICATION = T.StructType(
    [
        T.StructField("eligible", T.BooleanType()),
        T.StructField("employment_type", T.StringType()),
        T.StructField("region_constraint", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("reason", T.StringType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("lane", T.StringType()),
        T.StructField("ats", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("reason", T.StringType()),
        T.StructField("apply_url", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("screenshot", T.StringType()),
        T.StructField("cover_note", T.StringType()),
        T.StructField("answers", T.MapType(T.StringType(), T.StringType())),
    ]
)
PRIVATE_COLUMNS = ["cover_note", "answers"]

HISTORY = "url string, first_seen date"

SOURCE_REPORT = "source string, ok boolean, fetched bigint, duration_ms bigint, error string"

# Employment types and application states.
EMPLOYMENT_TYPES = ["b2b", "eor", "payroll", "unknown"]
STATUSES = ["applied", "dry-run", "review", "failed"]

# Source order. Employer copies come first and so survive the dedupe.
SOURCE_ORDER = [
    "company-sites",
    "greenhouse", "lever", "ashby", "workable", "recruitee", "smartrecruiters", "personio",
    "remotive", "remoteok", "arbeitnow", "himalayas", "jobicy", "weworkremotely", "linkedin", "job-boards",
]

RANK_STEP = 10**17


def posting_order(source_rank: Column, seq: Column) -> Column:
    """One BIGINT that orders postings by source, then by place inside the source."""
    return source_rank.cast("bigint") * F.lit(RANK_STEP) + seq.cast("bigint")


@dataclass(frozen=True)
class FilterRules:
    keywords: list[str] = field(default_factory=list)
    exclude_keywords: list[str] = field(default_factory=list)
    location_allow: list[str] = field(default_factory=list)
    location_block: list[str] = field(default_factory=list)
    max_age_days: float = 14


@dataclass(frozen=True)
class SelectionRules:
    """The defaults of the action stage."""

    daily_cap: int = 8
    min_confidence: float = 0.8
    employment_types: tuple[str, ...] = ("b2b", "unknown")
    company_cooldown_days: float = 60
    max_age_days: float = 10
    retry_failed_after_days: float = 2
    review_prep_limit: int = 10
    exclude_companies: tuple[str, ...] = ()
    try_unknown_sites: bool = True


@dataclass(frozen=True)
class Pricing:
    """List price in USD per million tokens."""

    input_per_million: float = 0.15
    output_per_million: float = 0.6


REVIEW_BELOW = 0.6
MAX_LINKS_PER_SITE = 30


def as_lit(moment: datetime | Column) -> Column:
    return moment if isinstance(moment, Column) else F.lit(moment).cast("timestamp")
