"""Posting-shaped inputs derived from the benchmark tables, in Spark and as SQL text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.schema import FilterRules

NOW = datetime(2001, 9, 1)
EVENTS_NOW = datetime(2024, 3, 1)

RULES = FilterRules(
    keywords=["ring", "bolt", "gear", "plate", "gizmo", "promo", "brand#1"],
    exclude_keywords=["old", "hot plate"],
    location_allow=["america", "europe", "asia", "remote"],
    location_block=["us only", "europe on-site"],
    max_age_days=2000,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def postings_star(spark: SparkSession, sf_dir: str, by_supplier: DataFrame | None = None) -> DataFrame:
    """One posting per order line: company, title, place and date come from the joined tables.

    Part, supplier and orders grow with the data, so their join strategy is left to the
    optimizer's size check. Orders come first and part last, so that shuffles for the joins
    carry keys and dates, not names. Lines are dealt by their order once, which serves the
    aggregate and the join.

    ``by_supplier`` has ``s_suppkey`` and columns to add; it is joined while rows lie by supplier.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .repartition("l_orderkey")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.min("l_partkey").alias("p_partkey"), F.min("l_suppkey").alias("s_suppkey"))
    )
    supplied = (
        lines.join(
            table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey"
        )
        .join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey"), "s_suppkey")
        .join(
            table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey"), "s_nationkey"
        )
        .join(table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey")
    )
    added = [] if by_supplier is None else [c for c in by_supplier.columns if c != "s_suppkey"]
    if by_supplier is not None:
        # Names of their own: the star has a region already.
        supplied = supplied.join(by_supplier.withColumnsRenamed({c: f"_{c}" for c in added}), "s_suppkey")
    joined = (
        supplied.join(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand"), "p_partkey")
    )
    return joined.select(
        F.expr("concat('src', l_orderkey % 16)").alias("source"),
        F.expr("cast(l_orderkey % 16 as int)").alias("source_rank"),
        F.expr("l_orderkey * 10 + l_linenumber").alias("seq"),
        F.expr("(l_orderkey % 16) * 1000000000000000 + l_orderkey * 10 + l_linenumber").alias("ord"),
        F.expr(
            "concat(s_name, case l_linenumber % 3 when 1 then ' GmbH' when 2 then ' Ltd.' else '' end)"
        ).alias("company"),
        F.expr(
            "concat(p_name, case l_linenumber % 4 when 1 then ' (Remote)' when 2 then ' - Contract'"
            " when 3 then ' (m/f/d)' else '' end)"
        ).alias("title"),
        F.expr(
            "case when l_orderkey % 11 = 0 then '' when l_orderkey % 7 = 0 then concat(r_name, ' US only')"
            " when l_orderkey % 5 = 0 then concat('Remote, ', r_name) else r_name end"
        ).alias("location"),
        F.expr(
            "concat('https://jobs.example.com/', p_partkey,"
            " case l_linenumber % 3 when 0 then '?src=rss' when 1 then '/' else '' end)"
        ).alias("url"),
        F.expr("cast(o_orderdate as timestamp)").alias("posted_at"),
        F.expr("array(p_type, p_brand)").alias("tags"),
        "l_orderkey",
        "l_linenumber",
        "p_partkey",
        "s_suppkey",
        *[F.col(f"_{c}").alias(c) for c in added],
    )


STAR_SQL = """
star AS (
  SELECT 'src' || (l.l_orderkey % 16) AS source, CAST(l.l_orderkey % 16 AS INTEGER) AS source_rank,
         l.l_orderkey * 10 + l.l_linenumber AS seq,
         (l.l_orderkey % 16) * 1000000000000000 + l.l_orderkey * 10 + l.l_linenumber AS ord,
         s_name || CASE l.l_linenumber % 3 WHEN 1 THEN ' GmbH' WHEN 2 THEN ' Ltd.' ELSE '' END AS company,
         p_name || CASE l.l_linenumber % 4 WHEN 1 THEN ' (Remote)' WHEN 2 THEN ' - Contract'
                                           WHEN 3 THEN ' (m/f/d)' ELSE '' END AS title,
         CASE WHEN l.l_orderkey % 11 = 0 THEN '' WHEN l.l_orderkey % 7 = 0 THEN r_name || ' US only'
              WHEN l.l_orderkey % 5 = 0 THEN 'Remote, ' || r_name ELSE r_name END AS location,
         'https://jobs.example.com/' || p_partkey ||
           CASE l.l_linenumber % 3 WHEN 0 THEN '?src=rss' WHEN 1 THEN '/' ELSE '' END AS url,
         CAST(o_orderdate AS TIMESTAMP) AS posted_at, p_type, p_brand, p_name, s_name, r_name,
         l.l_orderkey, l.l_linenumber, p_partkey, s_suppkey
  FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS lp, min(l_suppkey) AS ls
        FROM lineitem GROUP BY l_orderkey, l_linenumber) l
  JOIN part ON p_partkey = lp JOIN supplier ON s_suppkey = ls
  JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
  JOIN orders ON o_orderkey = l_orderkey
)"""

# The rules of RULES spelled out over the columns of ``star``.
REASON_SQL = """
CASE
  WHEN NOT regexp_matches(lower(title) || ' ' || lower(p_type || ' ' || p_brand), 'ring|bolt|gear|plate|gizmo|promo|brand#1')
    THEN 'no-keyword'
  WHEN lower(title) LIKE '%old%' OR lower(title) LIKE '%hot plate%' THEN 'excluded-keyword'
  WHEN lower(location) LIKE '%us only%' OR lower(location) LIKE '%europe on-site%' THEN 'blocked-location'
  WHEN location <> '' AND NOT regexp_matches(lower(location), 'america|europe|asia|remote') THEN 'location-not-allowed'
  WHEN posted_at < TIMESTAMP '2001-09-01' - INTERVAL 2000 DAY THEN 'stale'
END"""


def event_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as postings: the user is the url, the event the sighting."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("ord"),
        F.concat(F.lit("https://jobs.example.com/u/"), F.col("user_id")).alias("url"),
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
    )


def rounds_sql(source: str, rounds: int) -> str:
    """CTEs that settle ``source(url_key, title_key, ord)`` in unrolled rounds; ends in ``settled``."""
    steps = [f"r0 AS MATERIALIZED (SELECT url_key, title_key, min(ord) AS ord FROM {source} GROUP BY ALL)"]
    for i in range(rounds):
        steps.append(
            f"w{i} AS MATERIALIZED (SELECT url_key, title_key, ord FROM (SELECT *, min(ord) OVER (PARTITION BY url_key) AS mu,"
            f" min(ord) OVER (PARTITION BY title_key) AS mt FROM r{i}) WHERE ord = mu AND ord = mt)"
        )
        steps.append(
            f"r{i + 1} AS MATERIALIZED (SELECT * FROM r{i} WHERE url_key NOT IN (SELECT url_key FROM w{i})"
            f" AND title_key NOT IN (SELECT title_key FROM w{i}))"
        )
    union = " UNION ALL ".join(f"SELECT ord FROM w{i}" for i in range(rounds))
    # A row still undecided raises, so too few rounds cannot pass unseen.
    check = f"SELECT CASE WHEN count(*) > 0 THEN error('undecided rows left') END FROM r{rounds}"
    steps.append(f"settled AS (SELECT ord FROM ({union}) WHERE ({check}) IS NULL)")
    return ",\n".join(steps)
