"""Dedupe on small keys, history, ledger, selection and routing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwell.catalog.inputs import EVENTS_NOW, STAR_SQL, event_postings, postings_star, table
from siftwell.catalog.registry import query
from siftwell.operators import candidates as ca
from siftwell.operators import dedupe as dd
from siftwell.operators import distinct, history, ledger, ordering, routing, sinks, statelog
from siftwell.runtime import scratch
from siftwell.schema import HISTORY, SelectionRules

SPLIT = datetime(2024, 1, 15)
URL_SQL = "'https://jobs.example.com/u/' || user_id"


def key_sql(a: str, b: str) -> str:
    return f"'k' || {a} AS url_key, 't' || {b} AS title_key"


DOC_URL, DOC_TITLE = "(n_chars * 7 + doc_id) % 211", "(n_chars * 13 + doc_id * 3) % 173"


@query(
    "dedupe_greedy",
    f"""WITH RECURSIVE d AS (SELECT row_number() OVER (ORDER BY doc_id) AS n, doc_id, {key_sql(DOC_URL, DOC_TITLE)} FROM documents),
f(n, urls, titles, kept) AS (
  SELECT 0::BIGINT, []::VARCHAR[], []::VARCHAR[], NULL::BIGINT
  UNION ALL
  SELECT d.n, CASE WHEN list_contains(urls, url_key) OR list_contains(titles, title_key) THEN urls ELSE list_append(urls, url_key) END,
    CASE WHEN list_contains(urls, url_key) OR list_contains(titles, title_key) THEN titles ELSE list_append(titles, title_key) END,
    CASE WHEN list_contains(urls, url_key) OR list_contains(titles, title_key) THEN NULL ELSE d.doc_id END
  FROM f JOIN d ON d.n = f.n + 1)
SELECT kept AS doc_id FROM f WHERE kept IS NOT NULL""",
)
def dedupe_greedy(spark, sf_dir):
    """Many collisions on both keys, against a row-by-row fold."""
    keyed = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ord"),
        F.expr(f"concat('k', {DOC_URL})").alias("url_key"),
        F.expr(f"concat('t', {DOC_TITLE})").alias("title_key"),
    )
    return dd.kept_orders(keyed).select(F.col("ord").alias("doc_id"))


# Documents in a row, by id, each sharing its url with one neighbour and its title with the other;
# after 997 of them a new chain begins.
CHAIN = 997


@query("dedupe_chain", f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) WHERE i % {CHAIN} % 2 = 0")
def dedupe_chain(spark, sf_dir):
    """Long chains of postings that each depend on the one before: every second one stays."""
    placed = ordering.with_place(table(spark, sf_dir, "documents").select("doc_id"), F.col("doc_id"))
    keyed = placed.select(
        F.col("doc_id").alias("ord"),
        F.expr(f"concat_ws('/', 'u', (place - 1) div {CHAIN}, (place - 1) % {CHAIN} div 2)").alias("url_key"),
        F.expr(f"concat_ws('/', 't', (place - 1) div {CHAIN}, ((place - 1) % {CHAIN} + 1) div 2)").alias("title_key"),
    )
    return dd.kept_orders(keyed).select(F.col("ord").alias("doc_id"))


@query("dedupe_removed", f"WITH {STAR_SQL} SELECT count(*) - (SELECT count(DISTINCT p_partkey) FROM star) AS removed FROM star")
def dedupe_removed(spark, sf_dir):
    """How many postings the dedupe drops when every company and title pair is its own."""
    star = postings_star(spark, sf_dir)
    keyed = star.select("ord", F.col("p_partkey").cast("string").alias("url_key"), F.col("ord").cast("string").alias("title_key"))
    kept = dd.kept_orders(keyed)
    return star.agg(F.count(F.lit(1)).alias("rows")).select((F.col("rows") - kept.agg(F.count(F.lit(1))).scalar()).alias("removed"))


@query("distinct_first", "SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def distinct_first(spark, sf_dir):
    return distinct.first_per_key(event_postings(spark, sf_dir), ["user_id"], "ord").select(
        "user_id", F.col("ord").alias("event_id"), "event_type"
    )


@query("latest_per_key", "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def latest_per_key(spark, sf_dir):
    return distinct.latest_per_key(event_postings(spark, sf_dir), ["user_id"], "ord").select(
        "user_id", F.col("ord").alias("event_id"), "event_type"
    )


def known_history(spark, sf_dir) -> DataFrame:
    """First day per user among the events before the split."""
    before = event_postings(spark, sf_dir).where(F.col("ts") < F.lit(SPLIT))
    return before.groupBy("url").agg(F.to_date(F.min("ts")).alias("first_seen"))


KNOWN_SQL = f"known AS (SELECT {URL_SQL} AS url, CAST(min(ts) AS DATE) AS first_seen FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY user_id)"
LATER_SQL = f"later AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE 'x' || event_id % 2000 || '/' || {URL_SQL} END AS url FROM events UNION ALL SELECT -1 - event_id, {URL_SQL} FROM events)"


def later_postings(spark, sf_dir) -> DataFrame:
    """Urls of a later run: a third of them empty, some unknown, some known."""
    e = event_postings(spark, sf_dir)
    some = e.select(F.col("ord"), F.expr("case when ord % 3 = 0 then '' else concat('x', ord % 2000, '/', url) end").alias("url"))
    return some.unionByName(e.select((-1 - F.col("ord")).alias("ord"), "url"))


@query(
    "history_update",
    f"""WITH {KNOWN_SQL}, {LATER_SQL} SELECT url, strftime(first_seen, '%Y-%m-%d') AS first_seen FROM known
UNION ALL SELECT DISTINCT url, '2024-03-01' FROM later WHERE url <> '' AND url NOT IN (SELECT url FROM known)""",
)
def history_update(spark, sf_dir):
    updated = history.update_first_seen(later_postings(spark, sf_dir), known_history(spark, sf_dir), EVENTS_NOW)
    return updated.select("url", F.date_format("first_seen", "yyyy-MM-dd").alias("first_seen"))


@query(
    "history_join",
    f"""WITH {KNOWN_SQL}, {LATER_SQL} SELECT event_id AS id, l.url, k.url IS NULL AND l.url <> '' AS is_new,
  coalesce(date_diff('day', k.first_seen, DATE '2024-03-01'), -1) AS age_days FROM later l LEFT JOIN known k USING (url)""",
)
def history_join(spark, sf_dir):
    """New flags and ages for rows of which a third share one (empty) url."""
    known = known_history(spark, sf_dir)
    aged = history.with_age(later_postings(spark, sf_dir), known, EVENTS_NOW)
    is_new = F.col("first_seen").isNull() & (F.col("url") != "")
    return aged.select(F.col("ord").alias("id"), "url", is_new.alias("is_new"), F.coalesce("age_days", F.lit(-1)).alias("age_days"))


@query(
    "history_new_count",
    f"WITH {KNOWN_SQL}, {LATER_SQL} SELECT count(DISTINCT url) AS new_since_last_run FROM later WHERE url <> '' AND url NOT IN (SELECT url FROM known)",
)
def history_new_count(spark, sf_dir):
    return history.new_count(later_postings(spark, sf_dir), known_history(spark, sf_dir), EVENTS_NOW)


# Events as an action log: the posting is a user's url, the event type decides status and lane.
STATUS = "CASE event_type WHEN 'purchase' THEN 'applied' WHEN 'click' THEN 'dry-run' WHEN 'error' THEN 'failed' ELSE 'review' END"


def action_log(spark, sf_dir) -> DataFrame:
    e = event_postings(spark, sf_dir)
    return e.select(
        "ord",
        "url",
        F.expr("concat('Company ', user_id % 40)").alias("company"),
        F.expr("concat('Role ', user_id)").alias("title"),
        F.lit("ats").alias("lane"),
        F.lit("lever").alias("ats"),
        F.expr(STATUS.lower()).alias("status"),
        F.col("ts").alias("at"),
        F.expr("case when event_type = 'error' then concat('e', ord) end").alias("reason"),
        F.expr("concat('https://form.example.com/', user_id % 60)").alias("apply_url"),
        F.lit(None).cast("string").alias("email"),
        F.lit(None).cast("string").alias("screenshot"),
        F.expr("case when event_type = 'view' then concat('note ', ord) end").alias("cover_note"),
        F.expr("case when event_type in ('view', 'click') then map('Rate', cast(value as string)) end").alias("answers"),
    )


LOG_SQL = f"""log AS (SELECT event_id AS ord, {URL_SQL} AS url, user_id, 'Company ' || user_id % 40 AS company, 'Role ' || user_id AS title,
  {STATUS} AS status, ts AS at_, CASE WHEN event_type = 'error' THEN 'e' || event_id END AS reason,
  'https://form.example.com/' || user_id % 60 AS apply_url, CASE WHEN event_type = 'view' THEN 'note ' || event_id END AS cover_note,
  event_type IN ('view', 'click') AS has_note, value FROM events),
latest AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY url ORDER BY ord DESC) = 1)"""


@query(
    "ledger_split",
    f"""WITH {LOG_SQL}, notes AS (SELECT * FROM log WHERE has_note QUALIFY row_number() OVER (PARTITION BY url ORDER BY ord DESC) = 1)
SELECT l.url, l.status, coalesce(n.cover_note, '') AS cover_note, n.url IS NOT NULL AS has_answers
FROM latest l LEFT JOIN notes n USING (url)""",
)
def ledger_split(spark, sf_dir):
    """Public and private halves stored apart and merged again."""
    log = action_log(spark, sf_dir)
    public = ledger.latest_records(ledger.public_records(log))
    merged = ledger.with_private_notes(public, ledger.private_notes(log))
    return merged.select("url", "status", F.coalesce("cover_note", F.lit("")).alias("cover_note"), F.col("answers").isNotNull().alias("has_answers"))


@query(
    "mark_done",
    f"""WITH {LOG_SQL}, keys AS (SELECT DISTINCT CASE WHEN c_custkey % 3 = 0 THEN 'https://jobs.example.com/u/' || c_custkey
    WHEN c_custkey % 3 = 1 THEN 'https://form.example.com/' || c_custkey ELSE 'https://nowhere.example.com/' || c_custkey END AS key FROM customer),
forms AS (SELECT apply_url, arg_min(url, ord) AS url FROM latest GROUP BY apply_url),
hit AS (SELECT key, coalesce(l.url, f.url) AS url FROM keys LEFT JOIN latest l ON l.url = key LEFT JOIN forms f ON f.apply_url = key)
SELECT DISTINCT 'done' AS kind, url AS name, 'applied' AS status, 'applied manually' AS reason FROM hit WHERE url IS NOT NULL
UNION ALL SELECT 'unknown', key, '', '' FROM hit WHERE url IS NULL""",
)
def mark_done(spark, sf_dir):
    """Postings handled by hand, named by posting url or by form url."""
    keys = table(spark, sf_dir, "customer").selectExpr(
        """case when c_custkey % 3 = 0 then concat('https://jobs.example.com/u/', c_custkey)
           when c_custkey % 3 = 1 then concat('https://form.example.com/', c_custkey)
           else concat('https://nowhere.example.com/', c_custkey) end as key"""
    )
    done, unknown = ledger.mark_done(ledger.latest_records(action_log(spark, sf_dir)), keys, EVENTS_NOW)
    blank = F.lit("")
    return done.select(F.lit("done").alias("kind"), F.col("url").alias("name"), "status", "reason").unionByName(
        unknown.select(F.lit("unknown").alias("kind"), F.col("key").alias("name"), blank.alias("status"), blank.alias("reason"))
    )


@query(
    "state_load_policy",
    f"WITH {KNOWN_SQL} SELECT 'sound' AS table_state, count(*) AS n FROM known UNION ALL SELECT 'damaged', 0 UNION ALL SELECT 'missing', 0",
)
def state_load_policy(spark, sf_dir):
    """A sound, a damaged and a missing state table, read tolerantly."""
    root = scratch(spark)
    known = known_history(spark, sf_dir)
    sinks.append_state(known, f"{root}/sound")
    known.select(F.concat(F.to_json(F.struct("*")), F.when(F.col("url").endswith("7"), F.lit(" oops")).otherwise(F.lit(""))).alias("value")).write.text(f"{root}/damaged")
    out = None
    for name in ("sound", "damaged", "missing"):
        n = sinks.load_state(spark, f"{root}/{name}", HISTORY, on_corrupt="empty").agg(F.count(F.lit(1)).alias("n"))
        row = n.select(F.lit(name).alias("table_state"), "n")
        out = row if out is None else out.unionByName(row)
    return out


# Scored postings: the star with a rule for eligibility and confidence.
SCORE = {
    "eligible": "seq % 3 <> 0",
    "employment_type": "CASE seq % 4 WHEN 0 THEN 'b2b' WHEN 1 THEN 'unknown' WHEN 2 THEN 'payroll' ELSE 'b2b' END",
    "confidence": "(seq % 20) / 20.0",
}


def scored_star(spark, sf_dir) -> DataFrame:
    star = postings_star(spark, sf_dir)
    classification = F.struct(
        F.expr(SCORE["eligible"]).alias("eligible"),
        F.expr(SCORE["employment_type"].lower()).alias("employment_type"),
        F.lit("").alias("region_constraint"),
        F.expr("cast(seq % 20 as double) / 20.0").alias("confidence"),
        F.concat(F.lit("because "), F.col("seq")).alias("reason"),
    )
    return star.withColumn("classification", classification)


def star_log(spark, sf_dir) -> DataFrame:
    """Earlier actions on star postings: one per customer, on the part with its key."""
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('https://jobs.example.com/', c_custkey, '/') as url",
        "concat('Supplier#', lpad(cast(c_custkey % 400 as string), 9, '0')) as company",
        "case c_custkey % 3 when 0 then 'failed' when 1 then 'applied' else 'review' end as status",
        "timestamp '2001-09-01' - make_dt_interval(cast(c_custkey % 90 as int)) as at",
    )


@query(
    "select_candidates",
    f"""WITH {STAR_SQL},
hist AS (SELECT 'https://jobs.example.com/' || c_custkey AS url, TIMESTAMP '2001-09-01' - to_days(CAST(c_custkey % 30 AS INTEGER)) AS first_seen FROM customer),
led AS (SELECT 'https://jobs.example.com/' || c_custkey || '/' AS url, 'supplier' || lpad(CAST(c_custkey % 400 AS VARCHAR), 9, '0') AS ck,
  CASE c_custkey % 3 WHEN 0 THEN 'failed' WHEN 1 THEN 'applied' ELSE 'review' END AS status,
  TIMESTAMP '2001-09-01' - to_days(CAST(c_custkey % 90 AS INTEGER)) AS at_ FROM customer),
s AS (SELECT *, regexp_replace(lower(company), '[^a-z0-9]', '', 'g') AS ck FROM star
  WHERE {SCORE["eligible"]} AND {SCORE["confidence"]} >= 0.8 AND {SCORE["employment_type"]} IN ('b2b', 'unknown')),
ok AS (SELECT s.* FROM s LEFT JOIN hist h ON h.url = s.url LEFT JOIN led l ON l.url = s.url
  WHERE s.ck NOT IN ('supplier000000007', 'supplier000000011gmbh')
    AND s.ck NOT IN (SELECT ck FROM led WHERE status = 'applied' AND at_ > TIMESTAMP '2001-09-01' - INTERVAL 60 DAY)
    AND (h.url IS NULL OR h.first_seen >= TIMESTAMP '2001-09-01' - INTERVAL 10 DAY)
    AND (l.url IS NULL OR (l.status = 'failed' AND l.at_ < TIMESTAMP '2001-09-01' - INTERVAL 2 DAY)))
SELECT ck AS company_key, seq, url FROM ok QUALIFY row_number() OVER (PARTITION BY ck ORDER BY posted_at DESC, ord) = 1""",
)
def select_candidates(spark, sf_dir):
    """One posting per company that passes confidence, type, exclusion, cooldown, age and ledger gates."""
    seen = table(spark, sf_dir, "customer").selectExpr(
        "concat('https://jobs.example.com/', c_custkey) as url",
        "cast(timestamp '2001-09-01' - make_dt_interval(cast(c_custkey % 30 as int)) as date) as first_seen",
    )
    rules = SelectionRules(exclude_companies=("Supplier#000000007", "Supplier#000000011 GmbH"))
    picked = ca.select_candidates(scored_star(spark, sf_dir), star_log(spark, sf_dir), seen, rules, datetime(2001, 9, 1))
    return picked.select("company_key", "seq", "url")


@query("daily_cap", f"WITH {LOG_SQL} SELECT greatest(0, 8 - count(*)) AS budget FROM latest WHERE status = 'applied' AND CAST(at_ AS DATE) = (SELECT CAST(max(at_) AS DATE) FROM latest WHERE at_ < TIMESTAMP '2024-01-20')")
def daily_cap(spark, sf_dir):
    current = ledger.latest_records(action_log(spark, sf_dir))
    day = current.where(F.col("at") < F.lit(datetime(2024, 1, 20))).agg(F.max("at")).scalar()
    return ca.submission_budget(current, SelectionRules(), day)


@query(
    "budget_take",
    f"""WITH {LOG_SQL}, a AS (SELECT *, sum(CASE WHEN status IN ('applied', 'dry-run') THEN 1 ELSE 0 END) OVER w AS used,
  sum(CASE WHEN status = 'review' AND cover_note IS NOT NULL THEN 1 ELSE 0 END) OVER w AS noted
  FROM log WINDOW w AS (ORDER BY at_ DESC, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT ord AS event_id, status, coalesce(noted, 0) < 10 AS prep FROM a WHERE coalesce(used, 0) < 37""",
)
def budget_take(spark, sf_dir):
    """Attempts newest first until 37 submissions; the first ten noted review items get a note."""
    attempts = action_log(spark, sf_dir).withColumn("posted_at", F.col("at"))
    done = ca.process_in_budget(attempts, 37, SelectionRules())
    return done.select(F.col("ord").alias("event_id"), "status", "prep")


ROUTE_URL = """case o_orderkey % 10 when 0 then concat('mailto:hr', o_orderkey, '@example.com?subject=x')
 when 1 then concat('https://jobs.lever.co/acme/', o_orderkey) when 2 then concat('https://de.linkedin.com/jobs/', o_orderkey)
 when 3 then concat('https://remoteok.com/j/', o_orderkey) when 4 then concat('https://acme.example.com/j/', o_orderkey)
 when 5 then concat('https://careers.acme.example.com/?gh_jid=', o_orderkey) when 6 then 'no url'
 when 7 then concat('https://indeed.co.uk/', o_orderkey) else concat('https://jobicy.com/', o_orderkey) end"""


@query(
    "route_lanes",
    """SELECT o_orderkey,
 CASE o_orderkey % 10 WHEN 0 THEN 'email' WHEN 1 THEN 'ats' WHEN 2 THEN 'review' WHEN 3 THEN 'resolve' WHEN 4 THEN 'ats' WHEN 5 THEN 'ats'
   WHEN 6 THEN 'review' WHEN 7 THEN 'review' WHEN 8 THEN 'email' ELSE 'resolve' END AS lane,
 CASE o_orderkey % 10 WHEN 1 THEN 'lever' WHEN 4 THEN 'generic' WHEN 5 THEN 'greenhouse' ELSE '' END AS ats,
 CASE o_orderkey % 10 WHEN 1 THEN 'https://jobs.lever.co/acme/' || o_orderkey || '/apply' WHEN 4 THEN 'https://acme.example.com/j/' || o_orderkey
   WHEN 5 THEN CASE WHEN o_orderkey % 4 = 1 THEN 'https://job-boards.greenhouse.io/embed/job_app?for=acme&token=' || o_orderkey
                    ELSE 'https://careers.acme.example.com/?gh_jid=' || o_orderkey END ELSE '' END AS apply_url,
 CASE o_orderkey % 10 WHEN 0 THEN 'hr' || o_orderkey || '@example.com' WHEN 8 THEN 'jobs' || o_orderkey || '@example.com' ELSE '' END AS email,
 CASE o_orderkey % 10 WHEN 2 THEN 'de.linkedin.com does not allow automated applications' WHEN 7 THEN 'indeed.co.uk does not allow automated applications'
   WHEN 6 THEN 'unsupported application site (no url)' ELSE '' END AS reason FROM orders""",
)
def route_lanes(spark, sf_dir):
    posted = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr(ROUTE_URL).alias("url"),
        F.lit("acme").alias("company"),
        F.expr("case when o_orderkey % 4 = 1 then 'greenhouse' else 'remotive' end").alias("source"),
        F.expr("case when o_orderkey % 10 = 8 then concat('Send your CV to jobs', o_orderkey, '@example.com') else 'info@example.com' end").alias("description"),
    )
    routed = routing.with_route(posted, try_unknown_sites=True)
    blank = F.lit("")
    return routed.select("o_orderkey", *[F.coalesce(f"route.{f}", blank).alias(f) for f in routing.ROUTE_FIELDS])


LINK = """CASE l_linenumber % 6 WHEN 0 THEN 'https://jobs.ashbyhq.com/acme/' || seq WHEN 1 THEN 'https://remoteok.com/more' WHEN 2 THEN 'https://x.example.com/'
 WHEN 3 THEN 'mailto:hr' || seq || '@example.com' WHEN 4 THEN 'https://acme.recruitee.com/o/' || seq ELSE 'https://www.linkedin.com/x' END"""


@query(
    "resolve_links",
    f"""WITH {STAR_SQL}, l AS (SELECT l_orderkey, l_linenumber, seq, {LINK} AS link FROM star),
hit AS (SELECT l_orderkey, arg_min(CASE l_linenumber % 6 WHEN 0 THEN 'ats ' || link || '/application' WHEN 3 THEN 'email hr' || seq || '@example.com'
   ELSE 'ats ' || link || '/c/new' END, l_linenumber) AS found FROM l WHERE l_linenumber % 6 IN (0, 3, 4) GROUP BY l_orderkey)
SELECT DISTINCT l_orderkey, coalesce(found, 'review could not find where the aggregator sends applications') AS found FROM l LEFT JOIN hit USING (l_orderkey)""",
)
def resolve_links(spark, sf_dir):
    """Aggregator postings resolved by the links of their page, one page per order."""
    star = postings_star(spark, sf_dir)
    links = star.select(F.col("l_orderkey").alias("ord"), F.col("l_linenumber").alias("pos"), F.expr(LINK.lower()).alias("link"))
    postings = links.select("ord").distinct().withColumn("company", F.lit("acme")).withColumn("source", F.lit("remoteok"))
    resolved = routing.resolve_aggregators(postings, links)
    r = F.col("route")
    return resolved.select(F.col("ord").alias("l_orderkey"), F.concat_ws(" ", r["lane"], F.coalesce(r["apply_url"], r["email"], r["reason"])).alias("found"))


@query(
    "newest_first_page",
    f"WITH {STAR_SQL} SELECT seq, CAST(row_number() OVER (ORDER BY posted_at DESC, ord) AS BIGINT) AS place FROM star QUALIFY place <= 100",
)
def newest_first_page(spark, sf_dir):
    """The hundred newest postings with their place: a top-k report."""
    top = ordering.newest_first(postings_star(spark, sf_dir)).limit(100)
    # The window sees the hundred rows of the report only.
    place = F.row_number().over(Window.orderBy(F.col("posted_at").desc(), F.col("ord")))
    return top.withColumn("place", place.cast("bigint")).select("seq", "place")


@query("newest_first", f"WITH {STAR_SQL} SELECT seq, row_number() OVER (ORDER BY posted_at DESC, ord) AS place FROM star")
def newest_first(spark, sf_dir):
    """Every posting's place, newest first."""
    rows = postings_star(spark, sf_dir).select("seq", "posted_at", "ord")
    return ordering.newest_first_places(rows).select("seq", "place")


@query(
    "state_compacted",
    f"""WITH {LOG_SQL} SELECT 'ledger' AS state, url, status AS value FROM latest
UNION ALL SELECT 'history', url, strftime(min(day), '%Y-%m-%d') FROM (SELECT {URL_SQL} AS url, CAST(ts AS DATE) AS day FROM events) GROUP BY url""",
)
def state_compacted(spark, sf_dir):
    """Ledger and history written in many changes, merged twice in between, and read back."""
    root = scratch(spark)
    log = action_log(spark, sf_dir)
    days = event_postings(spark, sf_dir).select("url", F.to_date("ts").alias("first_seen"), "ord")
    records, seen = statelog.ledger_log(spark, f"{root}/ledger"), statelog.history_log(spark, f"{root}/history")
    for part in range(5):
        # The newest first, so that the order of the changes decides nothing.
        records.append(log.where(F.col("ord") % 5 == 4 - part))
        seen.append(days.where(F.col("ord") % 5 == part))
        if part in (1, 3):
            records.compact()
            seen.compact()
    return (
        records.read().select(F.lit("ledger").alias("state"), "url", F.col("status").alias("value"))
        .unionByName(seen.read().select(F.lit("history").alias("state"), "url", F.date_format("first_seen", "yyyy-MM-dd").alias("value")))
    )
