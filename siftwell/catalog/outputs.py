"""Run reports, digests, files and incremental runs."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.catalog.inputs import NOW, REASON_SQL, RULES, STAR_SQL, event_postings, postings_star
from siftwell.catalog.registry import query
from siftwell.catalog.state import LOG_SQL, action_log, scored_star
from siftwell.operators import history, ledger, prefilter, reports, sinks
from siftwell.runtime import cut_lineage, scratch
from siftwell.streaming import incremental

PART_SEEN = "p_partkey % 3 = 0"
SEEN_SQL = f"seen AS (SELECT DISTINCT url, DATE '2001-08-01' + CAST(p_partkey % 31 AS INTEGER) AS first_seen FROM star WHERE {PART_SEEN})"
SCORED_SQL = """scored AS (SELECT *, seq % 3 <> 0 AS eligible, CASE seq % 4 WHEN 0 THEN 'b2b' WHEN 1 THEN 'unknown' WHEN 2 THEN 'payroll' ELSE 'b2b' END AS type,
  (seq % 20) / 20.0 AS confidence FROM star)"""


def star_history(star: DataFrame) -> DataFrame:
    seen = star.where(PART_SEEN).select("url", F.expr("date_add(date '2001-08-01', cast(p_partkey % 31 as int))").alias("first_seen"))
    return seen.distinct()


def scored_with_history(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Scored star postings with new flags and ages; many share a url."""
    scored = cut_lineage(scored_star(spark, sf_dir).withColumn("salary", F.expr("case when seq % 5 = 0 then '5k' end")))
    seen = cut_lineage(star_history(scored))
    aged = history.with_age(scored, seen, NOW)
    return aged.withColumn("is_new", F.col("first_seen").isNull()), seen


@query(
    "run_totals",
    f"""WITH {STAR_SQL}, {SEEN_SQL}, {SCORED_SQL}, marked AS (SELECT {REASON_SQL} AS reason FROM star)
SELECT (SELECT count(*) FROM marked) AS fetched, (SELECT count(*) FROM marked WHERE reason IS NULL) AS after_prefilter,
  (SELECT count(DISTINCT p_partkey) FROM star) AS after_dedupe, (SELECT count(*) FROM scored) AS classified,
  (SELECT count(*) FROM scored WHERE eligible) AS eligible, (SELECT count(DISTINCT url) FROM star WHERE url NOT IN (SELECT url FROM seen)) AS new_since_last_run""",
)
def run_totals(spark, sf_dir):
    scored, _ = scored_with_history(spark, sf_dir)
    star = postings_star(spark, sf_dir)
    marked = prefilter.with_drop_reason(star, RULES, NOW)
    return reports.run_totals(marked, star.select("p_partkey").distinct(), scored)


@query(
    "run_health",
    f"""WITH {LOG_SQL}, r AS (SELECT company, count(*) FILTER (status <> 'failed') > count(*) FILTER (status = 'failed') * 4 AS ok FROM log GROUP BY company)
SELECT count(*) FILTER (ok) AS ok_sources, count(*) AS sources, count(*) FILTER (ok) / count(*) > 0.5 AS healthy FROM r""",
)
def run_health(spark, sf_dir):
    """Companies of the action log as sources; one is ok while few of its actions failed."""
    failed = F.count_if(F.col("status") == "failed")
    report = action_log(spark, sf_dir).groupBy(F.col("company").alias("source")).agg((F.count(F.lit(1)) - failed > failed * 4).alias("ok"))
    return reports.run_health(report)


@query(
    "run_guard",
    f"""WITH {STAR_SQL} SELECT source, true AS ok, count(*) AS fetched, '' AS error FROM star GROUP BY source
UNION ALL SELECT 'broken', false, 0, 'feed is down'""",
)
def run_guard(spark, sf_dir):
    """Sources run one by one to a table; a broken one is named and does not end the run."""
    root = scratch(spark)
    star = cut_lineage(postings_star(spark, sf_dir).select("source", "seq", "title", "url"))

    def write(name):
        def to_table(rows: DataFrame) -> int:
            rows.write.mode("overwrite").parquet(f"{root}/{name}")
            return spark.read.parquet(f"{root}/{name}").count()

        return to_table

    def broken() -> DataFrame:
        raise RuntimeError("feed is down")

    out = reports.run_source(spark, "broken", broken, write("broken"))
    for name in [f"src{i}" for i in range(16)]:
        rows = star.where(F.col("source") == name).select("seq", "title", "url")
        out = out.unionByName(reports.run_source(spark, name, lambda rows=rows: rows, write(name)))
    return out.select("source", "ok", "fetched", F.coalesce("error", F.lit("")).alias("error"))


ENTRY_SQL = """CASE WHEN confidence < 0.6 THEN '- [' || title || '](' || url || ') — ' || company || ' · confidence ' || confidence || chr(10) || '  because ' || seq
    ELSE '- **[' || title || '](' || url || ')** — ' || company || chr(10) || '  ' || CASE WHEN location = '' THEN 'location not stated' ELSE location END
      || ' · ' || type || CASE WHEN seq % 5 = 0 THEN ' · 5k' ELSE '' END || CASE WHEN age <> 0 THEN ' · seen ' || age || 'd' ELSE '' END
      || chr(10) || '  because ' || seq END"""


@query(
    "digest_sections",
    f"""WITH {STAR_SQL}, {SEEN_SQL}, {SCORED_SQL}, d AS (SELECT s.*, seen.url IS NULL AS is_new, coalesce(date_diff('day', first_seen, DATE '2001-09-01'), 0) AS age
  FROM scored s LEFT JOIN seen USING (url) WHERE eligible)
SELECT seq, CASE WHEN confidence < 0.6 THEN 3 WHEN is_new THEN 1 ELSE 2 END AS section, {ENTRY_SQL} AS line FROM d""",
)
def digest_sections(spark, sf_dir):
    scored, _ = scored_with_history(spark, sf_dir)
    sections = reports.digest_sections(scored)
    return sections.select("seq", "section", reports.digest_entry().alias("line"))


@query(
    "digest_text",
    f"""WITH {STAR_SQL}, {SEEN_SQL}, {SCORED_SQL}, d AS (SELECT s.*, CASE WHEN confidence < 0.6 THEN 3 WHEN seen.url IS NULL THEN 1 ELSE 2 END AS section,
  coalesce(date_diff('day', first_seen, DATE '2001-09-01'), 0) AS age FROM scored s LEFT JOIN seen USING (url) WHERE eligible),
n AS (SELECT count(*) FILTER (section = 1) AS a, count(*) FILTER (section = 2) AS b, count(*) FILTER (section = 3) AS c FROM d)
SELECT 0 AS part, -1 AS late, 0 AS at, 0 AS nth, '# Postings — 2001-09-01' || chr(10) || chr(10) || a || ' new, ' || b || ' still open, ' || c || ' needing a look.' AS line FROM n
UNION ALL SELECT DISTINCT section, -1, 0, 0, '## ' || ['New today', 'Still open', 'Low confidence, worth a glance'][section] FROM d
UNION ALL SELECT section, CASE WHEN posted_at IS NULL THEN 1 ELSE 0 END, coalesce(-epoch_us(posted_at), 0), ord, {ENTRY_SQL} FROM d
UNION ALL SELECT 4, -1, 0, 0, '## Sources that failed' UNION ALL SELECT 4, 0, 0, 0, '- broken: feed is down'""",
)
def digest_text(spark, sf_dir):
    """Every line of the digest with its place: title, headings, entries newest first, failed sources."""
    scored, _ = scored_with_history(spark, sf_dir)
    sources = spark.createDataFrame([("broken", False, "feed is down"), ("fine", True, None)], "source string, ok boolean, error string")
    lines = reports.digest_lines(reports.digest_sections(scored), sources, NOW)
    # A failed source is placed by a hash of its name.
    nth = F.when(F.col("part") == 4, F.lit(0)).otherwise(F.col("place.nth"))
    return lines.select("part", "place.late", "place.at", nth.cast("long").alias("nth"), "line")


@query(
    "run_summary",
    f"""WITH {LOG_SQL}, s AS (SELECT company AS source, count(*) FILTER (status <> 'failed') > count(*) FILTER (status = 'failed') * 4 AS ok,
  count(*) AS fetched FROM log GROUP BY company), f AS (SELECT count(*) AS n, string_agg(source, ', ' ORDER BY source) AS names FROM s WHERE NOT ok)
SELECT 0 AS part, '' AS source, 'Sources:' AS line UNION ALL
SELECT 1, source, '  ' || rpad(source, 16, ' ') || ' ' || CASE WHEN ok THEN fetched::VARCHAR ELSE 'FAILED (too many)' END || '  ' || fetched * 3 || 'ms' FROM s UNION ALL
SELECT 2, '', 'Fetched ' || count(*) || ', ' || count(*) FILTER (status <> 'failed') || ' past the prefilter, ' || count(DISTINCT url) || ' after dedupe, '
  || count(*) FILTER (status = 'applied') || ' eligible, 0 new since the last run.' FROM log UNION ALL
SELECT 3, '', 'Classifier: ' || count(*) || ' calls to local/plain, $1.2500.' FROM log UNION ALL
SELECT 4, '', n || ' source(s) failed: ' || names FROM f WHERE n > 0""",
)
def run_summary(spark, sf_dir):
    """The run report as text: sources with times, counters, the classifier's bill, failed sources."""
    log = action_log(spark, sf_dir)
    failed = F.count_if(F.col("status") == "failed")
    n = F.count(F.lit(1))
    sources = log.groupBy(F.col("company").alias("source")).agg((n - failed > failed * 4).alias("ok"), n.alias("fetched"))
    sources = sources.select("*", F.when(~F.col("ok"), F.lit("too many")).alias("error"), (F.col("fetched") * 3).alias("duration_ms"))
    totals = log.agg(
        n.alias("fetched"), (n - failed).alias("after_prefilter"), F.countDistinct("url").alias("after_dedupe"),
        F.count_if(F.col("status") == "applied").alias("eligible"), F.lit(0).cast("long").alias("new_since_last_run"),
    )
    bill = log.agg(n.alias("calls")).select("calls", F.lit("local").alias("provider"), F.lit("plain").alias("model"), F.lit(1.25).alias("cost_usd"))
    return reports.summary_lines(sources, totals, bill)


@query(
    "action_report",
    f"""WITH {LOG_SQL}, t AS (SELECT * FROM log WHERE at_ >= TIMESTAMP '2024-01-20'),
both_ AS (SELECT * FROM t WHERE status <> 'review' UNION ALL SELECT * FROM latest WHERE status = 'review')
SELECT ord AS event_id, CASE status WHEN 'applied' THEN 'Submitted today' WHEN 'dry-run' THEN 'Filled but not submitted, dry run' WHEN 'review' THEN 'Needs you' ELSE 'Errors' END AS section,
  '- **' || company || '**, ' || title || '  ' || chr(10) || '  ' || apply_url || CASE status WHEN 'review' THEN chr(10) || '  why: manual site'
    WHEN 'failed' THEN '  ' || chr(10) || '  ' || reason ELSE '' END AS line FROM both_""",
)
def action_report(spark, sf_dir):
    log = action_log(spark, sf_dir)
    today = log.where(F.col("at") >= F.lit(datetime(2024, 1, 20)))
    sections = reports.action_sections(today, ledger.latest_records(log))
    return sections.select(F.col("ord").alias("event_id"), "section", "line")


@query(
    "action_counts",
    f"""WITH {LOG_SQL}, n AS (SELECT status, count(*) AS n FROM log WHERE at_ >= TIMESTAMP '2024-01-20' AND status IN ('dry-run', 'failed') GROUP BY status
  UNION ALL SELECT status, count(*) FROM latest WHERE status = 'review' GROUP BY status),
s(section, status) AS (VALUES ('Submitted today', 'applied'), ('Filled but not submitted, dry run', 'dry-run'), ('Needs you', 'review'), ('Errors', 'failed'))
SELECT section, coalesce(n, 0) AS n FROM s LEFT JOIN n USING (status)""",
)
def action_counts(spark, sf_dir):
    """Section sizes on a day without submissions: the zero is shown."""
    log = action_log(spark, sf_dir)
    today = log.where((F.col("at") >= F.lit(datetime(2024, 1, 20))) & (F.col("status") != "applied"))
    return reports.action_counts(today, ledger.latest_records(log))


@query(
    "review_queue",
    f"WITH {LOG_SQL} SELECT url, company, title, strftime(at_, '%Y-%m-%d %H:%M:%S') AS at FROM latest WHERE status = 'review'",
)
def review_queue(spark, sf_dir):
    """Open review items of the ledger."""
    queue = reports.review_queue(ledger.latest_records(action_log(spark, sf_dir)))
    return queue.select("url", "company", "title", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(
    "csv_roundtrip",
    f"""WITH {STAR_SQL}, {SCORED_SQL} SELECT source, company || ' "quoted", ' || chr(10) || 'next' AS company, title, location, CASE WHEN seq % 5 = 0 THEN '5k' ELSE '' END AS salary,
  strftime(posted_at, '%Y-%m-%dT%H:%M:%S.000Z') AS "postedAt", eligible::VARCHAR AS eligible, type AS "employmentType", confidence::VARCHAR AS confidence,
  '' AS "regionConstraint", 'because ' || seq AS reason, url FROM scored""",
)
def csv_roundtrip(spark, sf_dir):
    """Written as CSV with quotes, commas and line ends in a value, and read back."""
    path = f"{scratch(spark)}/csv"
    scored = scored_star(spark, sf_dir).withColumn("salary", F.expr("case when seq % 5 = 0 then '5k' end"))
    sinks.write_csv(scored.withColumn("company", F.concat("company", F.lit(' "quoted", \nnext'))), path)
    return sinks.read_csv(spark, path)


@query(
    "json_snapshot",
    f"WITH {STAR_SQL}, {SCORED_SQL} SELECT 'latest' AS kind, count(*) AS n, count(DISTINCT url) AS urls FROM scored UNION ALL SELECT '2001-09-01', count(*), count(DISTINCT url) FROM scored WHERE eligible",
)
def json_snapshot(spark, sf_dir):
    """All scored postings, and the eligible ones under their day."""
    root = scratch(spark)
    sinks.write_snapshots(scored_star(spark, sf_dir), root, date(2001, 9, 1))
    counted = [F.count(F.lit(1)).alias("n"), F.countDistinct("url").alias("urls")]
    latest = sinks.read_latest(spark, root, "url string").groupBy(F.lit("latest").alias("kind")).agg(*counted)
    dated = sinks.read_days(spark, root, "url string")
    return latest.unionByName(dated.groupBy(F.col("run_date").cast("string").alias("kind")).agg(*counted))


def event_files(spark, sf_dir) -> str:
    """Events written as JSON files, some per day range, the way they would land."""
    path = f"{scratch(spark)}/landing"
    events = event_postings(spark, sf_dir).select("ord", "url", F.unix_micros("ts").alias("micros"), "event_type", "value")
    # As many files as the session has shuffle partitions.
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    events.repartitionByRange(files, "ord").write.json(path)
    return path


EVENT_SCHEMA = "ord bigint, url string, micros bigint, event_type string, value double"


@query("stream_ingest", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY event_type")
def stream_ingest(spark, sf_dir):
    """Landed files ingested in small batches until none is left."""
    root = scratch(spark)
    landing = event_files(spark, sf_dir)
    incremental.ingest(spark, landing, EVENT_SCHEMA, lambda df: df, f"{root}/silver", f"{root}/progress", files_per_batch=2)
    silver = spark.read.parquet(f"{root}/silver")
    return silver.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("value"))


@query(
    "stream_first_seen",
    "SELECT 'https://jobs.example.com/u/' || user_id AS url, strftime(min(ts), '%Y-%m-%d') AS first_seen FROM events GROUP BY user_id",
)
def stream_first_seen(spark, sf_dir):
    """First-seen dates kept across micro-batches of one file each, in whatever order they come."""
    root = scratch(spark)
    landing = event_files(spark, sf_dir)
    stream = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).json(landing)
    incremental.stream_first_seen(stream.withColumn("ts", F.timestamp_micros("micros")), f"{root}/history", f"{root}/progress")
    known = incremental.first_seen_table(spark, f"{root}/history")
    return known.select("url", F.date_format("first_seen", "yyyy-MM-dd").alias("first_seen"))
