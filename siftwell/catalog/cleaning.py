"""Filtering, dedupe and the daily shortlist."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwell.catalog.inputs import NOW, REASON_SQL, RULES, STAR_SQL, postings_star, rounds_sql, table
from siftwell.catalog.registry import query
from siftwell.runtime import scratch
from siftwell.operators import dedupe as dd
from siftwell.operators import prefilter
from siftwell.plans.daily import shortlist

# The dedupe keys of a supplier name: '#' becomes a blank.
TITLE_KEY_SQL = "replace(lower(s_name), '#', ' ') || '|' || lower(p_name)"


@query(
    "daily_shortlist",
    f"""WITH {STAR_SQL},
marked AS (SELECT *, {REASON_SQL} AS reason FROM star),
keys AS (SELECT 'jobs.example.com/' || p_partkey AS url_key, {TITLE_KEY_SQL} AS title_key, ord
         FROM marked WHERE reason IS NULL),
{rounds_sql("keys", 8)},
seen AS (SELECT 'https://jobs.example.com/' || user_id AS url, CAST(min(ts) AS DATE) AS first_seen
         FROM events GROUP BY user_id)
SELECT m.source, m.seq, m.company, m.title, m.url, strftime(m.posted_at, '%Y-%m-%d') AS posted_on,
       seen.url IS NULL AS is_new
FROM marked m JOIN settled USING (ord) LEFT JOIN seen ON seen.url = m.url""",
)
def daily_shortlist(spark, sf_dir):
    """Filter, dedupe, newest first, and which ones are new since earlier runs."""
    history = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.to_date(F.min("ts")).alias("first_seen"))
        .select(F.concat(F.lit("https://jobs.example.com/"), F.col("user_id")).alias("url"), "first_seen")
    )
    return shortlist(postings_star(spark, sf_dir), RULES, history, NOW).select(
        "source", "seq", "company", "title", "url", F.date_format("posted_at", "yyyy-MM-dd").alias("posted_on"),
        "is_new",
    )


@query("prefilter_reasons", f"WITH {STAR_SQL} SELECT seq, coalesce({REASON_SQL}, 'kept') AS verdict FROM star")
def prefilter_reasons(spark, sf_dir):
    marked = prefilter.with_drop_reason(postings_star(spark, sf_dir), RULES, NOW)
    return marked.select("seq", F.coalesce("drop_reason", F.lit("kept")).alias("verdict"))


# 5,000 keywords by a rule: every third supplier number.
MANY_KEYWORDS = [f"Supplier#{i:09d}" for i in range(0, 15_000, 3)]


@query(
    "many_keywords",
    f"""WITH {STAR_SQL} SELECT seq, CAST(substr(s_name, 10, 9) AS INTEGER) % 3 = 0 AND CAST(substr(s_name, 10, 9) AS INTEGER) < 15000 AS found FROM star""",
)
def many_keywords(spark, sf_dir):
    """Postings whose company holds one of 5,000 keywords, found in one pass."""
    star = postings_star(spark, sf_dir)
    return star.select("seq", prefilter.contains_any(F.lower("company"), MANY_KEYWORDS).alias("found"))


@query(
    "observed_counts",
    f"""WITH {STAR_SQL}, m AS (SELECT coalesce({REASON_SQL}, 'kept') AS reason FROM star)
SELECT reason AS counter, count(*) AS n FROM m WHERE reason <> 'kept' GROUP BY reason
UNION ALL SELECT 'fetched', count(*) FROM m UNION ALL SELECT 'after_prefilter', count(*) FROM m WHERE reason = 'kept'
UNION ALL SELECT 'written', count(*) FROM m WHERE reason = 'kept'""",
)
def observed_counts(spark, sf_dir):
    """Counters that are taken while the kept postings are written, without another pass."""
    marked = prefilter.with_drop_reason(postings_star(spark, sf_dir), RULES, NOW)
    observed, counters = prefilter.observe_reasons(marked)
    path = f"{scratch(spark)}/kept"
    prefilter.kept(observed).select("seq").write.parquet(path)
    counted = {k: v for k, v in counters.get.items() if v or k in ("fetched", "after_prefilter")}
    rows = spark.createDataFrame(list(counted.items()), "counter string, n bigint")
    return rows.unionByName(spark.read.parquet(path).agg(F.lit("written").alias("counter"), F.count(F.lit(1)).alias("n")))


@query(
    "drop_counts",
    f"""WITH {STAR_SQL}, reasons(drop_reason) AS (VALUES ('no-keyword'), ('excluded-keyword'), ('blocked-location'),
  ('location-not-allowed'), ('stale'))
SELECT r.drop_reason, count(m.reason) AS n FROM reasons r
LEFT JOIN (SELECT {REASON_SQL} AS reason FROM star) m ON m.reason = r.drop_reason GROUP BY r.drop_reason""",
)
def drop_counts(spark, sf_dir):
    marked = prefilter.with_drop_reason(postings_star(spark, sf_dir), RULES, NOW)
    return prefilter.drop_counts(marked).select("drop_reason", "n")


@query(
    "dedupe_star",
    f"""WITH {STAR_SQL},
keys AS (SELECT 'jobs.example.com/' || p_partkey AS url_key, {TITLE_KEY_SQL} AS title_key, ord FROM star),
{rounds_sql("keys", 8)}
SELECT seq, company, title FROM star JOIN settled USING (ord)""",
)
def dedupe_star(spark, sf_dir):
    return dd.dedupe(postings_star(spark, sf_dir)).select("seq", "company", "title")
