"""The daily run: collect, filter, dedupe, order, score, remember, report."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from siftwell.operators import dedupe as dd
from siftwell.operators import prefilter, reports, scoring, sinks, statelog
from siftwell.operators.history import mark_new, unseen, with_age
from siftwell.operators.ordering import newest_first
from siftwell.runtime import cut_lineage
from siftwell.schema import POSTING, SOURCE_REPORT, FilterRules, Pricing
from siftwell.sources import collect, jsonld


def shortlist(
    postings: DataFrame, rules: FilterRules, history: DataFrame, now: datetime | Column, order: str = "ord"
) -> DataFrame:
    """Postings worth scoring: filtered, deduplicated, newest first, with ``is_new``."""
    # The filter leaves a small share; the dedupe and the sort read it several times.
    passing = cut_lineage(prefilter.kept(prefilter.with_drop_reason(postings, rules, now)))
    survivors = dd.dedupe(passing, order)
    return newest_first(mark_new(survivors, history), order=order)


@dataclass(frozen=True)
class DailyRun:
    """What a daily run produced. Everything is also written below its root.

    ``boards`` lists the boards that were wanted (``vendor``, ``slug``) and whether a document of
    theirs has landed; those that have not are for the next fetch.
    """

    scored: DataFrame
    sources: DataFrame
    totals: DataFrame
    drop_counts: DataFrame
    failed_companies: DataFrame
    boards: DataFrame


@dataclass(frozen=True)
class Web:
    """Landed pages, and the company sites and job boards to read on them."""

    pages: DataFrame
    sites: DataFrame | None = None
    boards: DataFrame | None = None


# Sources read side by side; each keeps the cluster busy for a part of its time only.
SOURCES_AT_ONCE = 4

Readers = dict[str, Callable[[], DataFrame]]


def land_sources(readers: Readers, silver: str, spark: SparkSession) -> DataFrame:
    """Each source written on its own; what the guards saw, a row per source.

    A source that cannot be read is reported and gives no rows; the others go on.
    """

    def guard(name: str) -> Row:
        def write(rows: DataFrame) -> int:
            counter = Observation()
            observed = collect.union_sources({name: rows}).observe(counter, F.count(F.lit(1)).alias("n"))
            observed.write.mode("overwrite").parquet(f"{silver}/part_of={name}")
            return counter.get["n"]

        return reports.run_source(spark, name, readers[name], write).first()

    with ThreadPoolExecutor(SOURCES_AT_ONCE) as pool:
        seen = list(pool.map(inheritable_thread_target(spark)(guard), readers))
    return spark.createDataFrame(seen, SOURCE_REPORT)


def landed_postings(guards: DataFrame, silver: str) -> DataFrame:
    """Postings of all sources that were read, as one table."""
    spark = guards.sparkSession
    paths = [f"{silver}/part_of={r['source']}" for r in guards.where("ok").collect()]
    schema = StructType(list(POSTING) + [StructField("ord", LongType())])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def land_sites(web: Web, silver: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Company sites, read before all other sources because they reveal boards.

    Returns what the guard saw, boards found (``vendor``, ``slug``, ``pos``), sites that gave nothing
    (``source``, ``company``, ``error``), and the number of sites.
    """
    spark, found = web.pages.sparkSession, []

    def read() -> DataFrame:
        sites = jsonld.from_company_sites(web.sites, web.pages)
        failed = sites.failed.select(F.lit(reports.COMPANY_SITES).alias("source"), "company", "error")
        found[:] = [sites.discovered.select("vendor", "slug", "pos"), cut_lineage(failed), web.sites.count()]
        return sites.postings

    guards = land_sources({reports.COMPANY_SITES: read}, silver, spark)
    if not found:
        boards = spark.createDataFrame([], f"vendor string, slug string, pos {BOARD_PLACE}")
        found = [boards, spark.createDataFrame([], "source string, company string, error string"), 0]
    return guards, *found


BOARD_PLACE = "struct<site: bigint, at: int, pos: int>"


def run_daily(
    bronze: DataFrame,
    root: str,
    rules: FilterRules,
    now: datetime,
    details: DataFrame | None = None,
    make_scorer: scoring.MakeScorer | None = None,
    prompt: scoring.Prompt = scoring.FULL,
    web: Web | None = None,
    pricing: Pricing = Pricing(),
    boards: DataFrame | None = None,
) -> DailyRun:
    """One run over a landing table, and over landed pages if given, written below ``root``.

    Company sites come first. With ``boards`` (``vendor``, ``slug`` and a whole number ``pos``), the
    boards that sites reveal are added to that list, and only documents of listed boards are read; a
    configured board of which nothing has landed is a failed company. Without, every landed
    document is read.

    Every source is read behind a guard of its own, some of them side by side. Postings and scores
    are written once and read back, so nothing is parsed or paid for twice; counters are taken while
    rows are written. The history is appended after the outputs, and an unhealthy run raises at the
    very end.
    """
    spark = bronze.sparkSession
    began = time.monotonic()
    silver = f"{root}/silver/run_date={now:%Y-%m-%d}"
    good, bad = collect.quarantine(bronze)
    bad = bad.select("source", "company", "error")
    readers: Readers = {}
    guards, sites, found = None, None, None
    if web is not None and web.sites is not None:
        guards, found, lost, sites = land_sites(web, silver)
        bad = bad.unionByName(lost)
    if web is not None and web.boards is not None:
        readers["job-boards"] = lambda: jsonld.from_board_listing(web.boards, web.pages)
    none = spark.createDataFrame([], f"vendor string, slug string, pos {BOARD_PLACE}")
    listed = none if boards is None else boards.withColumn("pos", collect.board_place(F.col("pos")))
    wanted = cut_lineage(collect.merge_board_lists(listed, none if found is None else found))
    documents = bronze.select(F.col("source").alias("vendor"), F.col("company").alias("slug")).distinct()
    wanted = cut_lineage(
        wanted.join(documents.withColumn("landed", F.lit(True)), ["vendor", "slug"], "left").select(
            "vendor", "slug", (F.col("part") == 0).alias("configured"), F.coalesce("landed", F.lit(False)).alias("landed")
        )
    )
    if boards is not None:
        good = collect.only_boards(good, wanted)
        missing = wanted.where(F.col("configured") & ~F.col("landed"))
        bad = bad.unionByName(missing.select(F.col("vendor").alias("source"), F.col("slug").alias("company"), F.lit("not landed").alias("error")))
    bad = cut_lineage(bad)
    # The names of the sources that landed or should have: at most the registered ones.
    named = {r["source"] for r in bronze.select("source").union(wanted.where("configured").select("vendor")).distinct().collect()}
    frames = collect.source_frames(good, details)
    readers |= {n: (lambda f=f: f) for n, f in frames.items() if n in named}
    others = land_sources(readers, silver, spark)
    guards = others if guards is None else guards.unionByName(others)
    postings = landed_postings(guards, silver)

    marked, counters = prefilter.observe_reasons(prefilter.with_drop_reason(postings, rules, now))
    passing = cut_lineage(prefilter.kept(marked))
    deduped, deduped_n = _counted(dd.dedupe(passing), F.count(F.lit(1)).alias("after_dedupe"))
    bill = None
    if make_scorer is None:
        scored = scoring.score_disabled(deduped)
    else:
        # The whole hash: the short golden id is a label, and too short for a join key.
        keyed = deduped.withColumn("id", F.sha2(F.concat_ws("\u0001", "url", "company", "title"), 256))
        scores = scoring.score_once(keyed, make_scorer, prompt, f"{root}/scores")
        scores = cut_lineage(scores.join(keyed.select("id").distinct(), "id", "left_semi"))
        scored = keyed.join(scores.select("id", "classification"), "id").drop("id")
        bill = scoring.score_stats(scores, pricing=pricing)

    state = statelog.history_log(spark, f"{root}/history")
    history = cut_lineage(state.read())
    scored, scored_n = _counted(
        mark_new(scored, history).drop("first_seen"),
        F.count(F.lit(1)).alias("classified"),
        F.count_if(F.col("classification.eligible")).alias("eligible"),
    )
    fresh, fresh_n = _counted(unseen(scored, history, now), F.count(F.lit(1)).alias("new_since_last_run"))
    sources = cut_lineage(reports.landed_report(guards, bad, sites))
    seen = {**counters.get, **deduped_n.get, **scored_n.get, **fresh_n.get}
    totals = spark.createDataFrame([tuple(seen[n] for n in TOTALS)], ", ".join(f"{n} bigint" for n in TOTALS))
    reasons = [(r, i, seen[r]) for i, r in enumerate(prefilter.DROP_REASONS)]

    sinks.write_snapshots(scored, root, now.date())
    sinks.write_csv(newest_first(scored), f"{root}/latest_csv")
    sections = reports.digest_sections(with_age(scored, history, now))
    sinks.write_lines(reports.digest_lines(sections, sources, now), f"{root}/digest", "part", "place")
    wanted.write.mode("overwrite").json(f"{root}/boards")
    finished = now + timedelta(seconds=time.monotonic() - began)
    run = reports.run_report(sources, totals, now, finished, bill)
    run.write.mode("overwrite").json(f"{root}/run_report")
    state.append(fresh, f"{now:%Y-%m-%dT%H%M%S}")
    state.compact_if_due()
    reports.require_health(sources)
    return DailyRun(
        scored, sources, totals, spark.createDataFrame(reasons, "drop_reason string, rule int, n bigint"),
        bad.select("source", "company").distinct(), wanted.select("vendor", "slug", "landed"),
    )


# The counters of a run, in the order of its report.
TOTALS = ["fetched", "after_prefilter", "after_dedupe", "classified", "eligible", "new_since_last_run"]


def _counted(rows: DataFrame, *counters: Column) -> tuple[DataFrame, Observation]:
    """Rows written to the checkpoint folder, and what was counted meanwhile."""
    seen = Observation()
    return cut_lineage(rows.observe(seen, *counters)), seen
