"""Scalar functions over the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwell.catalog.inputs import EVENTS_NOW, STAR_SQL, postings_star, table
from siftwell.catalog.registry import query
from siftwell.functions import contact, dates, money, text, urls

RE_SPACE = (
    r"[\t\n\v\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
)


def nested(expr: str, steps: list[tuple[str, str]]) -> str:
    """SQL that applies regex replacements one after another."""
    for pattern, replacement in steps:
        pattern = pattern.replace("'", "''")
        expr = f"regexp_replace({expr}, '{pattern}', {replacement}, 'g')"
    return expr


NL, BLANK, NONE = "chr(10)", "' '", "''"
TRIM = [(f"^{RE_SPACE}+|{RE_SPACE}+$", NONE)]
STRIP = [
    (rf"(?i)<br{RE_SPACE}*/?>", NL),
    (r"(?i)</(p|div|li|h[1-6])>", NL),
    (r"<[^>]*>", BLANK),
    (r"(?i)&nbsp;", BLANK),
    (r"(?i)&amp;", "'&'"),
    (r"(?i)&lt;", "'<'"),
    (r"(?i)&gt;", "'>'"),
    (r"(?i)&#39;|&rsquo;", "chr(39)"),
    (r"(?i)&quot;|&ldquo;|&rdquo;", "'\"'"),
    (r"[ \t]+", BLANK),
    (r" *\n *", NL),
    (r"\n{3,}", "chr(10) || chr(10)"),
] + TRIM
TITLE = (
    [
        (r"\([^)]*\)", BLANK),
        (r"\[[^\]]*\]", BLANK),
        (rf"\b[mfhw]({RE_SPACE}*/{RE_SPACE}*[mfhwdx])+\b", BLANK),
        (r"[–—|/,:]+", BLANK),
        (r"[^a-z0-9+#. ]", BLANK),
    ]
    + [(rf"\b{p}\b", BLANK) for p in text.NOISE_PHRASES]
    + [(f"{RE_SPACE}+", BLANK)]
)
COMPANY = [
    (r"\b(gmbh|ltd|limited|inc|llc|b\.?v\.?|s\.?a\.?|ag|oy|ab)\b", BLANK),
    (r"[^a-z0-9 ]", BLANK),
    (f"{RE_SPACE}+", BLANK),
]

TITLE_TAIL = """case seq % 8 when 0 then ' | Contract | B2B' when 1 then ' (m/w/d) [EMEA]' when 2 then ' - Fully Remote, EMEA'
 when 3 then ' h/f' when 4 then ' – full time contractor' when 5 then ': all genders, work from home'
 when 6 then ' m / f / d WFH part time' else ' C++ / Node.js (full-time)' end"""


@query(
    "norm_title",
    f"""WITH {STAR_SQL},
titles AS (SELECT 'p' || seq AS id, title || {TITLE_TAIL} AS title FROM star
           UNION ALL SELECT 'd' || doc_id, text FROM documents)
SELECT id, md5(trim({nested("lower(title)", TITLE)})) AS title_md5, trim({nested("lower(title)", TITLE)}) = '' AS erased
FROM titles""",
)
def norm_title(spark, sf_dir):
    star = postings_star(spark, sf_dir).select(
        F.concat(F.lit("p"), F.col("seq")).alias("id"), F.concat("title", F.expr(TITLE_TAIL)).alias("title")
    )
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), F.col("text").alias("title"))
    named = star.unionByName(docs).select("id", text.normalise_title(F.col("title")).alias("t"))
    return named.select("id", F.md5("t").alias("title_md5"), (F.col("t") == "").alias("erased"))


COMPANY_TAIL = "case seq % 5 when 0 then ' B.V.' when 1 then ', Inc.' when 2 then ' S.A' when 3 then ' LLC & Co' else ' AG/Oy' end"


@query(
    "norm_company",
    f"""WITH {STAR_SQL}, c AS (SELECT seq, company || {COMPANY_TAIL} AS company FROM star)
SELECT seq, trim({nested("lower(company)", COMPANY)}) AS company FROM c""",
)
def norm_company(spark, sf_dir):
    star = postings_star(spark, sf_dir)
    return star.select("seq", text.normalise_company(F.concat("company", F.expr(COMPANY_TAIL))).alias("company"))


@query(
    "company_key",
    f"WITH {STAR_SQL} SELECT seq, regexp_replace(lower(company), '[^a-z0-9]', '', 'g') AS company_key FROM star",
)
def company_key(spark, sf_dir):
    return postings_star(spark, sf_dir).select("seq", text.company_key(F.col("company")).alias("company_key"))


@query(
    "canonical_url",
    f"""WITH {STAR_SQL}, plain AS (
  SELECT 'p' || page_id AS id, url FROM pages UNION ALL SELECT 's' || seq, url FROM star UNION ALL
  SELECT 'x' || page_id, 'Not A Url ' || page_id FROM pages)
SELECT id, lower(regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?://', ''), '/$', '')) AS url_key
FROM plain""",
)
def canonical_url(spark, sf_dir):
    """Landed urls as they are, in upper case, with default ports, dots, blanks around; and no urls."""
    pages = table(spark, sf_dir, "pages")
    messy = F.expr(
        """case page_id % 5 when 1 then regexp_replace(url, '^(https?)://([^/]+)', 'HTTPS://$2:443')
           when 2 then concat('  ', url, '\\n') when 3 then regexp_replace(url, '^(https?://[^/]+)/', '$1/a/../')
           when 4 then regexp_replace(url, '^(https?://[^/]+)/', '$1/./') else url end"""
    )
    star = postings_star(spark, sf_dir).select(F.concat(F.lit("s"), F.col("seq")).alias("id"), "url")
    both = (
        pages.select(F.concat(F.lit("p"), F.col("page_id")).alias("id"), messy.alias("url"))
        .unionByName(star)
        .unionByName(pages.select(F.expr("concat('x', page_id)").alias("id"), F.expr("concat('Not A Url ', page_id)").alias("url")))
    )
    return both.select("id", urls.canonical_url(F.col("url")).alias("url_key"))


@query("strip_html", f"SELECT page_id, md5({nested('html', STRIP)}) AS text_md5, length({nested('html', STRIP)}) AS n FROM pages")
def strip_html(spark, sf_dir):
    plain = table(spark, sf_dir, "pages").select("page_id", text.strip_html(F.col("html")).alias("t"))
    return plain.select("page_id", F.md5("t").alias("text_md5"), F.length("t").cast("bigint").alias("n"))


@query(
    "truncate",
    """SELECT doc_id, md5(CASE WHEN length(text) > 6000 THEN substr(text, 1, 6000) || chr(10) || '[truncated]' ELSE text END)
  AS text_md5, length(text) > 6000 AS cut FROM documents""",
)
def truncate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        F.md5(text.truncate(F.col("text"), text.MAX_DESCRIPTION_CHARS)).alias("text_md5"),
        (F.length("text") > text.MAX_DESCRIPTION_CHARS).alias("cut"),
    )


@query(
    "text_utils",
    """WITH d AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN '  ' WHEN doc_id % 3 = 1 THEN NULL ELSE lang END AS a,
  CASE WHEN doc_id % 2 = 0 THEN chr(160) ELSE ' ' || source END AS b,
  source || CASE WHEN doc_id % 4 = 0 THEN '' ELSE ' : ' || lang || ': x' END AS heading FROM documents)
SELECT doc_id,
  coalesce(CASE WHEN trim(a) <> '' THEN a END, CASE WHEN doc_id % 2 = 1 THEN b END, '') AS picked,
  concat_ws(' / ', CASE WHEN trim(a) <> '' THEN a END, CASE WHEN doc_id % 2 = 1 THEN b END, lang) AS joined,
  CASE WHEN doc_id % 4 = 0 THEN '' ELSE source END AS company,
  CASE WHEN doc_id % 4 = 0 THEN source ELSE lang || ': x' END AS title
FROM d""",
)
def text_utils(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        F.expr("case when doc_id % 3 = 0 then '  ' when doc_id % 3 = 1 then null else lang end").alias("a"),
        F.expr("case when doc_id % 2 = 0 then '\\u00a0' else concat(' ', source) end").alias("b"),
        F.expr("concat(source, case when doc_id % 4 = 0 then '' else concat(' : ', lang, ': x') end)").alias("heading"),
    )
    a, b, heading = F.col("a"), F.col("b"), F.col("heading")
    return docs.select(
        "doc_id",
        text.pick_string(a, b).alias("picked"),
        text.join_parts([a, b, F.col("lang")]).alias("joined"),
        text.before_first_colon(heading).alias("company"),
        text.after_first_colon(heading).alias("title"),
    )


@query(
    "iso_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (5, 7) THEN '' ELSE strftime(
  CAST(o_orderdate AS TIMESTAMP) + CASE o_orderkey % 8 WHEN 1 THEN INTERVAL 8 HOUR WHEN 6 THEN INTERVAL 15 HOUR
    ELSE INTERVAL 0 HOUR END, '%Y-%m-%dT%H:%M:%S.000Z') END AS posted_at FROM orders""",
)
def iso_dates(spark, sf_dir):
    """Order dates written in eight ways and read back."""
    written = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr(
            """case o_orderkey % 8 when 0 then date_format(o_orderdate, 'yyyy-MM-dd')
               when 1 then concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T10:00:00+02:00')
               when 2 then cast(unix_timestamp(o_orderdate) as string)
               when 3 then cast(case when o_orderdate >= timestamp_ntz '2001-09-10' then unix_timestamp(o_orderdate) * 1000
                                     else unix_timestamp(o_orderdate) end as string)
               when 4 then date_format(o_orderdate, 'EEE, dd MMM yyyy HH:mm:ss +0000')
               when 5 then concat('posted ', o_orderkey, ' days ago')
               when 6 then concat(date_format(o_orderdate, 'dd MMM yyyy'), ' 10:00 EST') else '' end"""
        ).alias("written"),
    )
    return written.select("o_orderkey", dates.to_iso_date(dates.text_to_timestamp(F.col("written"))).alias("posted_at"))


@query(
    "epoch_dates",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS from_seconds,
  strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS from_millis FROM events""",
)
def epoch_dates(spark, sf_dir):
    """Event times as epoch numbers in seconds and in milliseconds."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    seconds = dates.number_to_timestamp(F.unix_seconds("ts"))
    millis = dates.number_to_timestamp(F.unix_millis("ts"))
    return events.select(
        "event_id",
        F.date_format(seconds, "yyyy-MM-dd'T'HH:mm:ss").alias("from_seconds"),
        dates.to_iso_date(millis).alias("from_millis"),
    )


@query(
    "slugs_ids_hosts",
    f"""WITH {STAR_SQL}, s AS (SELECT 's' || seq AS id, regexp_replace(regexp_replace(lower(company || ' / ' || title),
    '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug,
    substr(sha1(CASE WHEN seq % 3 = 0 THEN company || '|' || title ELSE url END), 1, 12) AS golden_id,
    'jobs.example.com' AS host, 'Jobs' AS company FROM star)
SELECT id, substr(slug, 1, 60) AS slug, golden_id, host, company FROM s
UNION ALL SELECT 'p' || page_id, '', substr(sha1(url), 1, 12), regexp_extract(url, '^https?://([^/]+)', 1),
  upper(substr(regexp_replace(regexp_extract(url, '^https?://([^/]+)', 1), '^www\\.', ''), 1, 1)) ||
  substr(split_part(regexp_replace(regexp_extract(url, '^https?://([^/]+)', 1), '^www\\.', ''), '.', 1), 2) FROM pages""",
)
def slugs_ids_hosts(spark, sf_dir):
    star = postings_star(spark, sf_dir)
    url = F.when(F.col("seq") % 3 == 0, F.lit("")).otherwise(F.col("url"))
    host = urls.hostname(F.col("url"))
    a = star.select(
        F.concat(F.lit("s"), F.col("seq")).alias("id"),
        text.slug(F.concat_ws(" / ", "company", "title")).alias("slug"),
        text.golden_id(url, F.col("company"), F.col("title")).alias("golden_id"),
        host.alias("host"),
    )
    b = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id")).alias("id"),
        F.lit("").alias("slug"),
        text.golden_id(F.col("url"), F.lit(""), F.lit("")).alias("golden_id"),
        host.alias("host"),
    )
    return a.unionByName(b).withColumn("company", urls.company_from_domain(F.col("host")))


@query(
    "cost_age_format",
    """SELECT event_id, event_id / 1e6 * 0.15 + user_id / 1e6 * 0.6 AS cost,
  CASE WHEN user_id = 0 THEN 0.0 ELSE (event_id / 1e6 * 0.15 + user_id / 1e6 * 0.6) / user_id * 1000 END AS per_1k,
  date_diff('day', CAST(ts AS DATE), DATE '2024-03-01') AS age_days, (user_id % 101) || '.0%' AS share,
  printf('%.4f', CAST(event_id AS DOUBLE)) AS fixed, strftime(ts, '%Y-%m-%d') AS stamp FROM events""",
)
def cost_age_format(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    cost = money.estimate_cost(F.col("event_id"), F.col("user_id"), 0.15, 0.6)
    return events.select(
        "event_id",
        cost.alias("cost"),
        money.per_thousand(cost, F.col("user_id")).alias("per_1k"),
        dates.age_in_days(F.to_date("ts"), F.lit(EVENTS_NOW)).alias("age_days"),
        text.format_pct((F.col("user_id") % 101) / 100).alias("share"),
        money.to_fixed(F.col("event_id").cast("double"), 4).alias("fixed"),
        F.date_format(dates.first_seen_stamp(F.col("ts")), "yyyy-MM-dd").alias("stamp"),
    )


# Vendor urls over orders: kind, url, expected vendor, expected form url.
VENDOR_CASES = [
    ("'https://job-boards.greenhouse.io/acme/jobs/' || o_orderkey", "greenhouse",
     "'https://job-boards.greenhouse.io/embed/job_app?for=acme&token=' || o_orderkey"),
    ("'https://careers.acme.example.com/jobs?gh_jid=' || o_orderkey", "greenhouse",
     "'https://job-boards.greenhouse.io/embed/job_app?for=hint%20co&token=' || o_orderkey"),
    ("'https://jobs.eu.lever.co/acme/' || o_orderkey || '/?lever-source=x'", "lever",
     "'https://jobs.eu.lever.co/acme/' || o_orderkey || '/apply'"),
    ("'https://jobs.lever.co/acme/' || o_orderkey || '/apply'", "lever",
     "'https://jobs.lever.co/acme/' || o_orderkey || '/apply'"),
    ("'https://jobs.ashbyhq.com/acme/' || o_orderkey", "ashby",
     "'https://jobs.ashbyhq.com/acme/' || o_orderkey || '/application'"),
    ("'https://apply.workable.com/acme/j/' || o_orderkey || '/'", "workable",
     "'https://apply.workable.com/acme/j/' || o_orderkey || '/apply/'"),
    ("'https://acme.recruitee.com/o/' || o_orderkey", "recruitee",
     "'https://acme.recruitee.com/o/' || o_orderkey || '/c/new'"),
    ("'https://jobs.smartrecruiters.com/acme/' || o_orderkey", "smartrecruiters",
     "'https://jobs.smartrecruiters.com/acme/' || o_orderkey"),
    ("'https://acme.jobs.personio.de/job/' || o_orderkey", "personio",
     "'https://acme.jobs.personio.de/job/' || o_orderkey"),
    ("'https://www.notgreenhouse.io/jobs/' || o_orderkey", "",
     "'https://www.notgreenhouse.io/jobs/' || o_orderkey"),
    ("'no url ' || o_orderkey", "", "'no url ' || o_orderkey"),
]


def _case(values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE o_orderkey % {len(values)} {whens} END"


@query(
    "ats_and_apply_url",
    f"""SELECT o_orderkey, {_case([f"'{v}'" for _, v, _ in VENDOR_CASES])} AS ats,
  {_case([f for _, _, f in VENDOR_CASES])} AS apply_url FROM orders""",
)
def ats_and_apply_url(spark, sf_dir):
    posted = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_case([u for u, _, _ in VENDOR_CASES])).alias("url"))
    vendor = posted.withColumn("ats", urls.ats_from_url(F.col("url")))
    return vendor.select(
        "o_orderkey",
        F.coalesce("ats", F.lit("")).alias("ats"),
        F.coalesce(urls.apply_url_for(F.col("ats"), F.col("url"), F.lit("hint co")), "url").alias("apply_url"),
    )


MAIL_TEXT = """text || CASE doc_id % 6 WHEN 0 THEN ' Apply to hr' || doc_id || '@example.com today.'
  WHEN 1 THEN ' privacy@example.com. Send it to team@example.org or jobs@example.net.'
  WHEN 2 THEN ' Our lobby: hello@example.com.' WHEN 3 THEN ' no-reply@example.com, your CV' ELSE '' END"""


@query(
    "apply_email",
    f"""WITH d AS (SELECT doc_id, {MAIL_TEXT} AS text FROM documents),
m AS (SELECT doc_id, text, regexp_extract_all(text, '(?i)([A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{{2,}})') AS hits,
             string_split_regex(text, '(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{{2,}}') AS gaps FROM d WHERE text LIKE '%@%'),
u AS (SELECT doc_id, text, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i FROM m),
p AS (SELECT *, sum(length(gap)) OVER w + sum(length(hit)) OVER w - length(hit) AS ahead
      FROM u WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ok AS (SELECT doc_id, hit, i FROM p
  WHERE NOT regexp_matches(hit, '(?i)^(no-?reply|privacy|support|info|security|abuse|legal|press|dpo|gdpr)@')
    AND regexp_matches(lower(substr(text, CAST(greatest(ahead - 160, 0) + 1 AS BIGINT),
        CAST(ahead + length(hit) + 40 - greatest(ahead - 160, 0) AS BIGINT))),
      '\\b(apply|application|send|cv|resume|résumé|portfolio|reach out|email us|write to)\\b'))
SELECT d.doc_id, coalesce(f.hit, '') AS email FROM d LEFT JOIN
  (SELECT doc_id, arg_min(hit, i) AS hit FROM ok GROUP BY doc_id) f USING (doc_id)""",
)
def apply_email(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr(MAIL_TEXT).alias("text"))
    return docs.select("doc_id", F.coalesce(contact.extract_apply_email(F.col("text")), F.lit("")).alias("email"))


WANTED = """CASE p_partkey % 6 WHEN 0 THEN '  ' || upper(p_type) || ' ' WHEN 1 THEN substr(p_name, 1, 3)
  WHEN 2 THEN substr(p_name, 3, 4) WHEN 3 THEN p_name || ' please' WHEN 4 THEN 'zzz' ELSE ' ' END"""


@query(
    "pick_option",
    f"""WITH w AS (SELECT p_partkey, [p_brand, p_type, p_name, 'Yes', 'No'] AS o, trim(lower({WANTED})) AS w FROM part)
SELECT p_partkey, coalesce(CASE WHEN w <> '' THEN coalesce(
  list_filter(o, lambda x: trim(lower(x)) = w)[1], list_filter(o, lambda x: starts_with(lower(x), w))[1],
  list_filter(o, lambda x: contains(lower(x), w))[1],
  list_filter(o, lambda x: contains(w, trim(lower(x))) AND length(trim(x)) > 2)[1]) END, '') AS picked FROM w""",
)
def pick_option(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.array("p_brand", "p_type", "p_name", F.lit("Yes"), F.lit("No")).alias("o"), F.expr(WANTED).alias("w")
    )
    return parts.select("p_partkey", F.coalesce(text.pick_option(F.col("o"), F.col("w")), F.lit("")).alias("picked"))
