"""Run totals, source health, digests and action reports, as DataFrames."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from siftwell.functions.money import to_fixed
from siftwell.schema import REVIEW_BELOW, SOURCE_REPORT, as_lit

# Digest sections in reading order, and the words used in the texts.
DIGEST_SECTIONS = ["New today", "Still open", "Low confidence, worth a glance"]
ACTION_SECTIONS = {"applied": "Submitted today", "dry-run": "Filled but not submitted, dry run", "review": "Needs you", "failed": "Errors"}
NO_PLACE, NOTHING_TODAY, MANUAL_SITE = "location not stated", "Nothing matched today.", "manual site"
COMPANY_SITES = "company-sites"
FAILED_SOURCES = "Sources that failed"
PREVIEW_LINES = 12


class UnhealthyRun(RuntimeError):
    """More than half of the sources failed."""


def _filled(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


# ---- sources ----


def run_source(
    spark: SparkSession, source: str, read: Callable[[], DataFrame], write: Callable[[DataFrame], int]
) -> DataFrame:
    """Run one source to its sink and report it. A failure is named in the report, not raised.

    ``write`` materialises the rows and returns how many there were.
    """
    began = time.monotonic()
    try:
        fetched, error = write(read()), None
    except Exception as e:  # one broken source must not end the run
        fetched, error = 0, (str(e).splitlines() or [type(e).__name__])[0]
    took = int((time.monotonic() - began) * 1000)
    return spark.createDataFrame([Row(source, error is None, fetched, took, error)], SOURCE_REPORT)


def source_report(postings: DataFrame, failures: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source: rows fetched, whether it is ok, and how many companies failed.

    ``failures`` has source and company, and stays a table of its own, however many fail;
    ``sources`` lists the sources of the run. A source whose companies failed and that gave no
    rows at all is not ok.
    """
    fetched = postings.groupBy("source").agg(F.count(F.lit(1)).alias("fetched"))
    failed = (
        failures.select("source", "company")
        .distinct()
        .groupBy("source")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    text = F.concat(F.col("n").cast("string"), F.lit(" company slug(s) failed"))
    return (
        sources.select("source")
        .join(fetched, "source", "left")
        .join(failed, "source", "left")
        .select(
            "source",
            (F.col("n").isNull() | (F.coalesce("fetched", F.lit(0)) > 0)).alias("ok"),
            F.coalesce("fetched", F.lit(0)).alias("fetched"),
            text.alias("error"),
        )
    )


def guarded_report(report: DataFrame, guards: DataFrame) -> DataFrame:
    """Source reports joined with what the guard of each source saw (one row per source)."""
    g = guards.select("source", F.col("ok").alias("_ok"), "duration_ms", F.col("error").alias("_error"))
    return report.join(g, "source").select(
        "source", (F.col("ok") & F.col("_ok")).alias("ok"), "fetched", "duration_ms", F.coalesce("_error", "error").alias("error")
    )


def landed_report(guards: DataFrame, failures: DataFrame, sites: int | None = None) -> DataFrame:
    """Per source: what its guard saw, and how many of its companies failed.

    ``sites`` is the number of company sites that were read. They are a source that is ok unless
    each of them gave nothing; any other source with failed companies needs rows to be ok.
    """
    failed = failures.select("source", "company").distinct().groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    of_sites = F.col("source") == COMPANY_SITES
    total = F.lit(sites or 0)
    slugs = F.concat(F.col("n").cast("string"), F.lit(" company slug(s) failed"))
    text = F.when(of_sites, F.format_string("%d/%d site(s) gave nothing", "n", total)).otherwise(slugs)
    fine = F.when(of_sites, F.col("n") < total).otherwise(F.col("fetched") > 0)
    return guards.join(failed, "source", "left").select(
        "source",
        (F.col("ok") & (F.col("n").isNull() | fine)).alias("ok"),
        "fetched",
        "duration_ms",
        F.coalesce("error", F.when(F.col("n").isNotNull(), text)).alias("error"),
    )


def run_health(report: DataFrame) -> DataFrame:
    """One row: healthy when more than half of the sources are ok; never without sources."""
    ok, total = F.count_if("ok"), F.count(F.lit(1))
    share = F.try_divide(ok.cast("double"), total.cast("double"))
    return report.agg(
        ok.alias("ok_sources"), total.alias("sources"), F.coalesce(share > 0.5, F.lit(False)).alias("healthy")
    )


def require_health(report: DataFrame) -> None:
    """End a broken run with an error, after its outputs were written."""
    row = run_health(report).first()
    if not row["healthy"]:
        raise UnhealthyRun(f"{row['sources'] - row['ok_sources']} of {row['sources']} sources failed")


# ---- run ----


def run_totals(marked: DataFrame, deduped: DataFrame, scored: DataFrame) -> DataFrame:
    """One row of counters. ``marked`` carries ``drop_reason``; ``scored`` carries ``is_new``."""
    first = marked.agg(F.count(F.lit(1)).alias("fetched"), F.count_if(F.col("drop_reason").isNull()).alias("after_prefilter"))
    second = deduped.agg(F.count(F.lit(1)).alias("after_dedupe"))
    new_urls = F.countDistinct(F.when(F.col("is_new"), F.col("url")))
    third = scored.agg(
        F.count(F.lit(1)).alias("classified"),
        F.count_if(F.col("classification.eligible")).alias("eligible"),
        new_urls.alias("new_since_last_run"),
    )
    # Each side is one row.
    one = F.lit(1).alias("_run")
    joined = first.select("*", one).join(second.select("*", one), "_run").join(third.select("*", one), "_run")
    return joined.drop("_run")


def run_report(
    sources: DataFrame, totals: DataFrame, started: datetime, finished: datetime, classifier: DataFrame | None = None
) -> DataFrame:
    """One row that nests the source reports (one per source), the totals and the scorer's bill."""
    listed = sources.agg(F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in sources.columns]))).alias("sources"))
    one = F.lit(1).alias("_run")
    out = listed.select("*", one).join(totals.select(F.struct("*").alias("totals"), one), "_run")
    if classifier is not None:
        out = out.join(classifier.select(F.struct("*").alias("classifier"), one), "_run", "left")
    return out.drop("_run").select(as_lit(started).alias("started_at"), as_lit(finished).alias("finished_at"), "*")


def summary_lines(sources: DataFrame, totals: DataFrame, classifier: DataFrame | None = None) -> DataFrame:
    """The run report as ordered text lines (``part``, ``source``, ``line``).

    ``sources`` may carry ``duration_ms``; ``classifier`` is one row with calls, provider, model and
    cost_usd. A run has a fixed number of sources, whose names the last line lists.
    """
    status = F.when(F.col("ok"), F.col("fetched").cast("string")).otherwise(
        F.concat(F.lit("FAILED ("), F.coalesce("error", F.lit("")), F.lit(")"))
    )
    took = F.concat(F.lit("  "), F.col("duration_ms").cast("string"), F.lit("ms")) if "duration_ms" in sources.columns else F.lit("")
    line = F.concat(F.lit("  "), F.rpad("source", 16, " "), F.lit(" "), status, F.coalesce(took, F.lit("")))
    row = lambda part, text: (F.lit(part).alias("part"), F.lit("").alias("source"), text.alias("line"))
    counted = F.format_string(
        "Fetched %d, %d past the prefilter, %d after dedupe, %d eligible, %d new since the last run.",
        "fetched", "after_prefilter", "after_dedupe", "eligible", "new_since_last_run",
    )
    out = totals.select(*row(0, F.lit("Sources:")))
    out = out.unionByName(sources.select(F.lit(1).alias("part"), "source", line.alias("line")))
    out = out.unionByName(totals.select(*row(2, counted)))
    if classifier is not None:
        bill = F.format_string("Classifier: %d calls to %s/%s, $%s.", "calls", "provider", "model", to_fixed(F.col("cost_usd"), 4))
        out = out.unionByName(classifier.select(*row(3, bill)))
    lost = sources.where(~F.col("ok")).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("source")).alias("names"))
    named = F.format_string("%d source(s) failed: %s", "n", F.array_join("names", ", "))
    return out.unionByName(lost.where(F.col("n") > 0).select(*row(4, named))).orderBy("part", "source")


# ---- digest ----


def digest_sections(scored: DataFrame, review_below: float = REVIEW_BELOW) -> DataFrame:
    """Eligible postings with their ``section`` (1 new, 2 still open, 3 low confidence)."""
    c = F.col("classification")
    section = F.when(c["confidence"] < review_below, F.lit(3)).when(F.col("is_new"), F.lit(1)).otherwise(F.lit(2))
    return scored.where(c["eligible"]).withColumn("section", section)


def digest_counts(sections: DataFrame) -> DataFrame:
    return sections.agg(
        F.count_if(F.col("section") == 1).alias("fresh"),
        F.count_if(F.col("section") == 2).alias("ongoing"),
        F.count_if(F.col("section") == 3).alias("review"),
    )


def digest_entry() -> Column:
    """Text of one posting. Needs ``section`` and ``age_days`` besides the scored posting."""
    c = F.col("classification")
    age = F.when(F.coalesce(F.col("age_days"), F.lit(0)) != 0, F.format_string(" · seen %dd", "age_days"))
    salary = F.when(_filled(F.col("salary")), F.concat(F.lit(" · "), F.col("salary")))
    place = F.when(_filled(F.col("location")), F.col("location")).otherwise(F.lit(NO_PLACE))
    blank = F.lit("")
    full = F.concat(
        F.lit("- **["), F.col("title"), F.lit("]("), F.col("url"), F.lit(")** — "), F.col("company"),
        F.lit("\n  "), place, F.lit(" · "), c["employment_type"], F.coalesce(salary, blank), F.coalesce(age, blank),
        F.lit("\n  "), c["reason"],
    )
    short = F.concat(
        F.lit("- ["), F.col("title"), F.lit("]("), F.col("url"), F.lit(") — "), F.col("company"),
        F.lit(" · confidence "), c["confidence"].cast("string"), F.lit("\n  "), c["reason"],
    )
    return F.when(F.col("section") == 3, short).otherwise(full)


def digest_lines(
    sections: DataFrame, sources: DataFrame, now: datetime | Column, order: str = "ord", heading: str = "Postings"
) -> DataFrame:
    """The digest as ordered lines (``part``, ``place``, ``line``); write it after a sort by them.

    Entries are listed newest first, those without a date last.
    """

    def place(late: Column | int, at: Column | int, nth: Column | int) -> Column:
        late, at, nth = (c if isinstance(c, Column) else F.lit(c) for c in (late, at, nth))
        return F.struct(late.cast("int").alias("late"), at.cast("bigint").alias("at"), nth.cast("bigint").alias("nth")).alias("place")

    top = place(-1, 0, 0)
    head = digest_counts(sections)
    day = F.date_format(as_lit(now), "yyyy-MM-dd")
    title = head.select(
        F.lit(0).alias("part"),
        top,
        F.concat(
            F.lit(f"# {heading} — "), day, F.lit("\n\n"),
            F.format_string("%d new, %d still open, %d needing a look.", "fresh", "ongoing", "review"),
            F.when(F.col("fresh") + F.col("ongoing") + F.col("review") == 0, F.lit("\n\n" + NOTHING_TODAY)).otherwise(F.lit("")),
        ).alias("line"),
    )
    headings = F.element_at(F.array(*[F.lit(s) for s in DIGEST_SECTIONS]), F.col("section"))
    tops = sections.select("section").distinct().select(
        F.col("section").alias("part"), top, F.concat(F.lit("## "), headings).alias("line")
    )
    posted = F.col("posted_at")
    newest = place(posted.isNull(), F.coalesce(-F.unix_micros(posted), F.lit(0)), F.col(order))
    entries = sections.select(F.col("section").alias("part"), newest, digest_entry().alias("line"))
    broken = sources.where(~F.col("ok")).select(
        F.lit(4).alias("part"),
        place(0, 0, F.xxhash64("source")),
        F.concat(F.lit("- "), F.col("source"), F.lit(": "), F.coalesce("error", F.lit(""))).alias("line"),
    )
    failed = broken.limit(1).select("part", top, F.lit("## " + FAILED_SOURCES).alias("line"))
    return title.unionByName(tops).unionByName(entries).unionByName(failed).unionByName(broken)


# ---- actions ----


def action_sections(today: DataFrame, ledger: DataFrame) -> DataFrame:
    """Today's submissions, dry runs and errors, and every open review item of the ledger."""
    mine = today.where(F.col("status").isin("applied", "dry-run", "failed"))
    open_items = ledger.where(F.col("status") == "review")
    names = F.create_map(*[F.lit(x) for pair in ACTION_SECTIONS.items() for x in pair])
    both = mine.unionByName(open_items.select(*mine.columns))
    return both.withColumn("section", names[F.col("status")]).withColumn("line", action_line())


def action_line() -> Column:
    """Text of one record."""
    where = F.coalesce("apply_url", "url")
    mail = F.when(_filled(F.col("email")), F.concat(F.lit(" (email "), F.col("email"), F.lit(")")))
    base = F.concat(
        F.lit("- **"), F.col("company"), F.lit("**, "), F.col("title"), F.lit("  \n  "), where, F.coalesce(mail, F.lit(""))
    )
    why = F.concat(F.lit("\n  why: "), F.coalesce("reason", F.lit(MANUAL_SITE)))
    return (
        F.when(F.col("status") == "review", F.concat(base, why))
        .when(F.col("status") == "failed", F.concat(base, F.lit("  \n  "), F.coalesce("reason", F.lit(""))))
        .otherwise(base)
    )


def review_queue(ledger: DataFrame) -> DataFrame:
    """Open review items, newest first."""
    return ledger.where(F.col("status") == "review").orderBy(F.col("at").desc(), F.col("url"))


def action_counts(today: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows per section, zero included."""
    spark = today.sparkSession
    names = spark.createDataFrame([(s,) for s in ACTION_SECTIONS.values()], "section string")
    counts = action_sections(today, ledger).groupBy("section").agg(F.count(F.lit(1)).alias("n"))
    return names.join(F.broadcast(counts), "section", "left").select("section", F.coalesce("n", F.lit(0)).alias("n"))


# ---- labelling ----


def label_preview() -> Column:
    """What a labeller reads: heading lines and the first lines of the description that hold text."""
    lines = F.filter(F.split(F.coalesce("description", F.lit("")), "\n"), lambda x: x != "")
    body = F.array_join(F.slice(lines, 1, PREVIEW_LINES), "\n")
    place = F.when(_filled(F.col("location")), F.col("location")).otherwise(F.lit("(no location)"))
    date = F.coalesce(F.date_format("posted_at", "yyyy-MM-dd"), F.lit("(no date)"))
    return F.concat_ws(
        "\n",
        F.concat(F.col("company"), F.lit(" — "), F.col("title")),
        F.concat_ws(" · ", "source", place, date),
        F.col("url"),
        F.lit(""),
        F.when(body != "", body).otherwise(F.lit("(no description published)")),
    )
