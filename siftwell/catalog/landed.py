"""Vendor documents made from the benchmark tables and read back through every source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.catalog.inputs import STAR_SQL, postings_star, table
from siftwell.catalog.registry import query
from siftwell.operators import reports
from siftwell.runtime import scratch
from siftwell.sources import boards, collect, feeds, landing

# Place of a posting in its order's document, as the readers number it.
POSTS_SQL = f"""{STAR_SQL},
posts AS (SELECT *, l_orderkey * 1000000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS place,
  'co' || l_orderkey AS slug, strftime(posted_at, '%Y-%m-%d') AS day FROM star)"""


SLUG = "concat('co', l_orderkey)"


def posts(spark, sf_dir, by_supplier: DataFrame | None = None) -> DataFrame:
    star = postings_star(spark, sf_dir, by_supplier)
    return star.select("*", F.expr(SLUG).alias("slug"), F.date_format("posted_at", "yyyy-MM-dd").alias("day"))


def one_document_per_order(rows: DataFrame, source: str, item: Column, wrap) -> DataFrame:
    """Bronze rows: the (at most seven) lines of an order make one document of one company.

    The company's slug follows from the order, so the shuffle does not carry it.
    """
    items = rows.select("l_orderkey", F.struct("l_linenumber", item.alias("item")).alias("line"))
    grouped = items.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    listed = F.transform("lines", lambda x: x["item"])
    return grouped.select(
        F.lit(source).alias("source"),
        F.expr(SLUG).alias("company"),
        F.lit("").alias("url"),
        wrap(listed).alias("payload"),
        F.col("l_orderkey").alias("seq"),
    )


def json_list(name: str | None):
    def wrap(listed: Column) -> Column:
        return F.to_json(listed) if name is None else F.to_json(F.struct(listed.alias(name)))

    return wrap


def item_of(**fields: str) -> Column:
    return F.struct(*[F.expr(sql).alias(name) for name, sql in fields.items()])


def shown(postings: DataFrame) -> DataFrame:
    blank = F.lit("")
    return postings.select(
        "source",
        F.col("seq").alias("place"),
        "company",
        "title",
        "location",
        "url",
        F.coalesce(F.date_format("posted_at", "yyyy-MM-dd HH:mm:ss"), blank).alias("posted_at"),
        F.coalesce("salary", blank).alias("salary"),
        F.coalesce(F.array_join("tags", ","), blank).alias("tags"),
        "description",
    )


def expect(source: str, where: str = "true", **columns: str) -> str:
    base = {
        "company": "slug", "title": "title", "location": "location", "url": "url",
        "posted_at": "day || ' 00:00:00'", "salary": "''", "tags": "''", "description": "''",
    }
    listed = ", ".join(f"{sql} AS {name}" for name, sql in {**base, **columns}.items())
    return f"WITH {POSTS_SQL} SELECT '{source}' AS source, place, {listed} FROM posts WHERE {where}"


BODY = "concat('<p>About <b>', title, '</b> &amp; more</p><ul><li>', company, '</li></ul>')"
BODY_TEXT = "'About ' || title || ' & more' || chr(10) || company"


@query(
    "src_greenhouse",
    expect("greenhouse", "l_linenumber <> 5", location="CASE WHEN l_linenumber = 2 THEN '' ELSE location END", description=BODY_TEXT),
)
def src_greenhouse(spark, sf_dir):
    """Offset dates, a date only in the second field, a missing url, a number where text should be."""
    item = item_of(
        id="seq",
        title="title",
        updated_at="case when l_linenumber % 2 = 0 then concat(day, 'T02:00:00+02:00') end",
        first_published="day",
        location="case when l_linenumber = 2 then null else named_struct('name', location) end",
        absolute_url="case when l_linenumber = 5 then ' ' else url end",
        content=BODY,
    )
    return shown(boards.from_greenhouse(one_document_per_order(posts(spark, sf_dir), "greenhouse", item, json_list("jobs"))))


@query(
    "src_lever",
    expect(
        "lever",
        location="CASE WHEN location = '' THEN 'remote' ELSE location || ' / remote' END",
        url="CASE WHEN l_linenumber % 2 = 0 THEN url ELSE url || '#apply' END",
        description=f"CASE WHEN l_linenumber % 2 = 0 THEN title ELSE {BODY_TEXT} END",
    ),
)
def src_lever(spark, sf_dir):
    item = item_of(
        text="title",
        createdAt="unix_timestamp(posted_at) * case when posted_at < timestamp '2001-09-10' then 1 else 1000 end",
        categories="named_struct('location', location)",
        workplaceType="'remote'",
        hostedUrl="case when l_linenumber % 2 = 0 then url end",
        applyUrl="concat(url, '#apply')",
        descriptionPlain="case when l_linenumber % 2 = 0 then title else '  ' end",
        description=BODY,
    )
    return shown(boards.from_lever(one_document_per_order(posts(spark, sf_dir), "lever", item, json_list(None))))


@query(
    "src_ashby",
    expect(
        "ashby",
        location="concat_ws(' / ', CASE WHEN location <> '' THEN location END, CASE WHEN l_linenumber % 2 = 0 THEN 'Remote' END)",
        salary="CASE WHEN l_linenumber % 3 = 0 THEN '€' || p_partkey || 'K' ELSE '' END",
        description=BODY_TEXT,
    ),
)
def src_ashby(spark, sf_dir):
    item = item_of(
        title="title",
        publishedAt="concat(day, 'T00:00:00.000Z')",
        location="location",
        isRemote="l_linenumber % 2 = 0",
        jobUrl="url",
        compensation="case when l_linenumber % 3 = 0 then named_struct('compensationTierSummary', concat('€', p_partkey, 'K')) end",
        descriptionHtml=BODY,
    )
    return shown(boards.from_ashby(one_document_per_order(posts(spark, sf_dir), "ashby", item, json_list("jobs"))))


@query(
    "src_workable",
    expect(
        "workable",
        location="concat_ws(', ', source, CASE WHEN location <> '' THEN location END, CASE WHEN l_linenumber % 2 = 1 THEN 'Remote' END)",
        url="CASE WHEN l_linenumber = 1 THEN url || '#s' ELSE url END",
        description=f"CASE WHEN l_linenumber % 2 = 0 THEN {BODY_TEXT} ELSE 'Needs ' || title END",
    ),
)
def src_workable(spark, sf_dir):
    item = item_of(
        title="title",
        city="source",
        country="location",
        telecommuting="l_linenumber % 2 = 1",
        url="case when l_linenumber = 1 then '' else url end",
        shortlink="concat(url, '#s')",
        published_on="case when l_linenumber % 3 = 0 then day end",
        created_at="concat(day, ' 00:00:00')",
        description=f"case when l_linenumber % 2 = 0 then {BODY} else '' end",
        requirements="concat('Needs <i>', title, '</i>')",
    )
    return shown(boards.from_workable(one_document_per_order(posts(spark, sf_dir), "workable", item, json_list("jobs"))))


@query(
    "src_recruitee",
    expect(
        "recruitee",
        location="concat_ws(' / ', CASE WHEN location <> '' THEN location END, CASE WHEN l_linenumber > 3 THEN 'Remote' END)",
        description=BODY_TEXT,
    ),
)
def src_recruitee(spark, sf_dir):
    item = item_of(
        title="title", location="location", remote="l_linenumber > 3", careers_apply_url="url",
        created_at="concat(day, ' 00:00:00 UTC')", description=BODY,
    )
    return shown(boards.from_recruitee(one_document_per_order(posts(spark, sf_dir), "recruitee", item, json_list("offers"))))


@query(
    "src_smartrecruiters",
    expect(
        "smartrecruiters",
        company="CASE WHEN l_linenumber % 2 = 0 THEN company ELSE slug END",
        title="CASE WHEN l_linenumber % 3 = 0 THEN 'React ' || title ELSE title END",
        location="concat_ws(', ', source, upper(r_name), CASE WHEN l_linenumber % 2 = 1 THEN 'Remote' END)",
        url="'https://jobs.smartrecruiters.com/' || slug || '/' || seq",
        description="CASE WHEN l_linenumber % 3 = 0 AND seq % 7 <> 0 THEN 'Tasks' || chr(10) || title || chr(10) || chr(10) || 'About' || chr(10) || company ELSE '' END",
    ),
)
def src_smartrecruiters(spark, sf_dir):
    """Details exist for most postings but are read for plausible titles only."""
    region = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "r_name")
    rows = posts(spark, sf_dir, region).withColumn("location", F.col("r_name"))
    title = "case when l_linenumber % 3 = 0 then concat('React ', title) else title end"
    item = item_of(
        id="case when seq % 2 = 0 then cast(seq as string) else cast(seq as string) end",
        name=title,
        releasedDate="concat(day, 'T00:00:00.000Z')",
        location="named_struct('city', source, 'country', lower(regexp_replace(location, '^Remote, | US only$', '')), 'remote', l_linenumber % 2 = 1)",
        company="case when l_linenumber % 2 = 0 then named_struct('name', company) end",
    )
    sections = "named_struct('b', named_struct('title', 'Tasks', 'text', concat('<p>', title, '</p>')), 'a', named_struct('title', 'About', 'text', company))"
    details = rows.where("seq % 7 <> 0").select(
        F.col("slug").alias("company"),
        F.col("seq").cast("string").alias("id"),
        F.to_json(F.struct(F.struct(F.expr(sections).alias("sections")).alias("jobAd"))).alias("payload"),
    )
    bronze = one_document_per_order(rows, "smartrecruiters", item, json_list("content"))
    return shown(boards.from_smartrecruiters(bronze, details))


def _xml(c: str) -> str:
    return f"replace({c}, '&', '&amp;')"


@query(
    "src_personio",
    expect(
        "personio",
        company="CASE WHEN l_linenumber % 2 = 0 THEN company ELSE slug END",
        location="concat_ws(', ', source, CASE WHEN l_linenumber % 3 = 0 THEN 'Berlin' END, CASE WHEN l_linenumber % 3 = 0 THEN 'Beirut' END)",
        url="'https://' || slug || '.jobs.personio.de/job/' || seq",
        description="CASE WHEN l_linenumber % 2 = 1 THEN 'Employment type: freelance' || chr(10) ELSE '' END || 'Role' || chr(10) || title || ' & more' || chr(10) || chr(10) || 'Team' || chr(10) || company",
    ),
)
def src_personio(spark, sf_dir):
    position = F.expr(
        f"""concat('<position><id>', seq, '</id><name> ', {_xml('title')}, ' </name><office>', source, '</office>',
        case when l_linenumber % 3 = 0 then '<additionalOffices><office>Berlin</office><office>Beirut</office></additionalOffices>' else '' end,
        case when l_linenumber % 2 = 0 then concat('<subcompany>', {_xml('company')}, '</subcompany>')
             else '<employmentType>freelance</employmentType>' end,
        '<createdAt>', day, 'T01:00:00+01:00</createdAt><jobDescriptions><jobDescription><name>Role</name><value><![CDATA[<p>',
        title, ' &amp; more</p>]]></value></jobDescription><jobDescription><name>Team</name><value>', {_xml('company')},
        '</value></jobDescription></jobDescriptions></position>')"""
    )

    def wrap(listed: Column) -> Column:
        return F.concat(F.lit('<?xml version="1.0"?><workzag-jobs>'), F.array_join(listed, "\n"), F.lit("</workzag-jobs>"))

    return shown(boards.from_personio_xml(one_document_per_order(posts(spark, sf_dir), "personio", position, wrap)))


@query(
    "src_remotive",
    expect(
        "remotive", company="company",
        salary="CASE WHEN l_linenumber % 2 = 0 THEN '$' || p_partkey ELSE '' END",
        tags="CASE WHEN l_linenumber % 2 = 0 THEN p_type || ',' || p_brand ELSE '' END", description=BODY_TEXT,
    ),
)
def src_remotive(spark, sf_dir):
    item = item_of(
        company_name="company", title="title", candidate_required_location="location", url="url",
        publication_date="concat(day, 'T00:00:00')", salary="case when l_linenumber % 2 = 0 then concat('$', p_partkey) else '' end",
        tags="case when l_linenumber % 2 = 0 then tags end", description=BODY,
    )
    return shown(feeds.from_remotive(one_document_per_order(posts(spark, sf_dir), "remotive", item, json_list("jobs"))))


@query(
    "src_remoteok",
    expect(
        "remoteok", "l_linenumber <> 4", company="company",
        location="CASE WHEN location = '' THEN 'Worldwide' ELSE location END",
        salary="CASE WHEN l_linenumber % 2 = 0 THEN '$' || p_partkey + 1 || '-$' || p_partkey + 1000 ELSE '' END",
        tags="p_type || ',' || p_brand", description=BODY_TEXT,
    ).replace("SELECT 'remoteok' AS source, place,", "SELECT 'remoteok' AS source, place + 1 AS place,"),
)
def src_remoteok(spark, sf_dir):
    """The document opens with a notice; rows without a position are dropped; a zero is no salary."""
    item = item_of(
        id="seq", position="case when l_linenumber <> 4 then title end", company="company", location="location", url="url",
        date="concat(day, 'T00:00:00+00:00')", salary_min="case when l_linenumber % 2 = 0 then p_partkey + 1 else 0 end",
        salary_max="p_partkey + 1000", tags="tags", description=BODY,
    )

    def wrap(listed: Column) -> Column:
        # A document has a line at least, so a comma follows the notice.
        return F.regexp_replace(F.to_json(listed), r"\A\[", '[{"legal":"notice"},')

    return shown(feeds.from_remoteok(one_document_per_order(posts(spark, sf_dir), "remoteok", item, wrap)))


@query(
    "src_arbeitnow",
    expect(
        "arbeitnow", company="company",
        location="concat_ws(' / ', CASE WHEN location <> '' THEN location END, CASE WHEN l_linenumber % 2 = 0 THEN 'Remote' END)",
        tags="p_type || ',' || p_brand", description=BODY_TEXT,
    ),
)
def src_arbeitnow(spark, sf_dir):
    item = item_of(
        company_name="company", title="title", location="location", remote="l_linenumber % 2 = 0", url="url",
        created_at="unix_timestamp(posted_at)", tags="tags", description=BODY,
    )
    return shown(feeds.from_arbeitnow(one_document_per_order(posts(spark, sf_dir), "arbeitnow", item, json_list("data"))))


@query(
    "src_himalayas",
    expect(
        "himalayas", company="company",
        location="CASE WHEN l_linenumber % 2 = 0 THEN r_name || ', ' || source ELSE 'Worldwide' END",
        url="url || '#guid'", tags="p_type || ',' || p_brand",
        salary="CASE l_linenumber % 3 WHEN 0 THEN p_partkey + 1 || '-' || p_partkey + 9 || ' EUR' WHEN 1 THEN p_partkey + 1 || '-' || p_partkey + 9 ELSE '' END",
        description="'Short ' || title",
    ),
)
def src_himalayas(spark, sf_dir):
    rows = posts(spark, sf_dir)
    region = (
        table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "r_name")
    )
    item = item_of(
        companyName="company", title="title", locationRestrictions="case when l_linenumber % 2 = 0 then array(r_name, source) else array() end",
        applicationLink="''", guid="concat(url, '#guid')", pubDate="unix_timestamp(posted_at)", minSalary="p_partkey + 1",
        maxSalary="case when l_linenumber % 3 < 2 then p_partkey + 9 end", salaryCurrency="case when l_linenumber % 3 = 0 then 'EUR' end",
        categories="tags", excerpt="concat('Short ', title)",
    )
    return shown(feeds.from_himalayas(one_document_per_order(rows.join(region, "s_suppkey"), "himalayas", item, json_list("jobs"))))


@query(
    "src_jobicy",
    expect(
        "jobicy", company="company", title="'Dev & ' || title", tags="p_type || ',' || p_brand",
        salary="p_partkey + 1 || '-' || p_partkey + 9 || ' USD'", description=BODY_TEXT,
    ),
)
def src_jobicy(spark, sf_dir):
    item = item_of(
        companyName="company", jobTitle="concat('<b>Dev</b> &amp; ', title)", jobGeo="location", url="url",
        pubDate="concat(day, ' 00:00:00')", annualSalaryMin="cast(p_partkey + 1 as string)",
        annualSalaryMax="cast(p_partkey + 9 as string)", salaryCurrency="'USD'", jobIndustry="tags", jobExcerpt=BODY,
    )
    return shown(feeds.from_jobicy(one_document_per_order(posts(spark, sf_dir), "jobicy", item, json_list("jobs"))))


@query(
    "src_rss",
    expect(
        "weworkremotely",
        company="CASE WHEN l_linenumber = 3 THEN '' ELSE company END",
        title="CASE WHEN l_linenumber = 3 THEN title ELSE title || ': ' || source END",
        location="CASE WHEN location = '' THEN 'Remote' ELSE location END",
        description=BODY_TEXT,
    ),
)
def src_rss(spark, sf_dir):
    item = F.expr(
        f"""concat('<item><title>', case when l_linenumber = 3 then {_xml('title')}
          else concat({_xml('company')}, ': ', {_xml('title')}, ': ', source) end, '</title><region>', location, '</region><link>', url,
          '</link><pubDate>', date_format(posted_at, 'EEE, dd MMM yyyy HH:mm:ss'), ' +0000</pubDate><description>',
          replace(replace(replace({BODY}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '</description></item>')"""
    )

    def wrap(listed: Column) -> Column:
        return F.concat(F.lit('<rss version="2.0"><channel><title>jobs</title>'), F.array_join(listed, ""), F.lit("</channel></rss>"))

    return shown(feeds.from_rss(one_document_per_order(posts(spark, sf_dir), "weworkremotely", item, wrap)))


@query(
    "src_linkedin",
    expect(
        "linkedin",
        company="CASE WHEN l_linenumber % 7 = 0 THEN company ELSE company END",
        url="regexp_replace(url, '[?].*$', '')", posted_at="''", title="title || ' & Co'",
    ),
)
def src_linkedin(spark, sf_dir):
    card = F.expr(
        """concat('<li><a class="x base-card__full-link y" data-id="1" href="', url, '"> <i></i><span class="sr-only"> \n', title,
          ' &amp; <b>Co</b> </span></a><h4 class="base-search-card__subtitle"><a href="/c">', company,
          '</a></h4><span class="job-search-card__location">', location, '</span></li>')"""
    )
    return shown(
        feeds.from_linkedin_cards(
            one_document_per_order(posts(spark, sf_dir), "linkedin", card, lambda x: F.concat(F.lit("<ul>"), F.array_join(x, "\n"), F.lit("</ul>")))
        )
    )


def mixed_bronze(spark, sf_dir) -> DataFrame:
    """Four sources in one bronze table; some documents are damaged."""
    rows = posts(spark, sf_dir)
    gh = one_document_per_order(rows.where("l_orderkey % 16 < 4"), "greenhouse", item_of(title="title", absolute_url="url", updated_at="day"), json_list("jobs"))
    lv = one_document_per_order(
        rows.where("l_orderkey % 16 between 4 and 7"), "lever", item_of(text="title", hostedUrl="case when l_linenumber = 1 then '' else url end"), json_list(None)
    )
    ro = one_document_per_order(rows.where("l_orderkey % 16 between 8 and 11"), "remoteok", item_of(id="seq", position="title", url="url"), json_list(None))
    rm = one_document_per_order(rows.where("l_orderkey % 16 > 11"), "remotive", item_of(title="title", url="case when l_linenumber = 1 then '' else url end"), json_list("jobs"))
    bronze = gh.unionByName(lv).unionByName(ro).unionByName(rm)
    damaged = F.expr(
        "case when seq % 10 = 3 then substring(payload, 1, length(payload) - 2) when seq % 10 = 7 then concat(payload, ' oops')"
        " when seq % 10 = 9 then ' ' else payload end"
    )
    path = f"{scratch(spark)}/landed"
    landing.write_landed(bronze.withColumn("payload", damaged), path)
    return landing.read_landed(spark, path)


MIXED_SQL = f"""{POSTS_SQL},
m AS (SELECT *, CASE WHEN l_orderkey % 16 < 4 THEN 'greenhouse' WHEN l_orderkey % 16 < 8 THEN 'lever'
       WHEN l_orderkey % 16 < 12 THEN 'remoteok' ELSE 'remotive' END AS src,
       CASE l_orderkey % 10 WHEN 3 THEN 'not valid JSON' WHEN 7 THEN 'not valid JSON' WHEN 9 THEN 'empty payload' END AS error FROM posts)"""


@query(
    "union_ranked",
    f"""WITH {MIXED_SQL} SELECT src AS source, CASE src WHEN 'greenhouse' THEN 1 WHEN 'lever' THEN 2 WHEN 'remotive' THEN 8
  ELSE 9 END AS source_rank, place, title, CASE WHEN src = 'remotive' AND l_linenumber = 1 THEN '' ELSE url END AS url
FROM m WHERE error IS NULL AND NOT (src = 'lever' AND l_linenumber = 1)""",
)
def union_ranked(spark, sf_dir):
    """All sources of one bronze table after quarantine, in source order."""
    good, _ = collect.quarantine(mixed_bronze(spark, sf_dir))
    return collect.collect_bronze(good).select("source", "source_rank", F.col("seq").alias("place"), "title", "url")


@query(
    "valid_posting",
    f"""WITH {MIXED_SQL} SELECT src AS source, count(*) AS n,
  count(*) FILTER (src = 'remotive' AND l_linenumber = 1) AS without_url
FROM m WHERE error IS NULL AND NOT (src = 'lever' AND l_linenumber = 1) GROUP BY src""",
)
def valid_posting(spark, sf_dir):
    """Boards drop postings without a url, feeds keep them."""
    good, _ = collect.quarantine(mixed_bronze(spark, sf_dir))
    return (
        collect.collect_bronze(good)
        .groupBy("source")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("url") == "").alias("without_url"))
    )


@query(
    "quarantine",
    f"WITH {MIXED_SQL} SELECT src AS source, slug AS company, error FROM m WHERE error IS NOT NULL GROUP BY ALL",
)
def quarantine(spark, sf_dir):
    _, bad = collect.quarantine(mixed_bronze(spark, sf_dir))
    return bad.select("source", "company", "error")


@query(
    "source_report",
    f"""WITH {MIXED_SQL},
f AS (SELECT src, count(*) AS n FROM m WHERE error IS NULL AND NOT (src = 'lever' AND l_linenumber = 1) GROUP BY src),
b AS (SELECT src, count(DISTINCT slug) AS n FROM m
      WHERE error IS NOT NULL GROUP BY src),
s(src) AS (VALUES ('greenhouse'), ('lever'), ('remotive'), ('remoteok'), ('ashby'))
SELECT src AS source, b.n IS NULL OR coalesce(f.n, 0) > 0 AS ok, coalesce(f.n, 0) AS fetched,
  coalesce(b.n || ' company slug(s) failed', '') AS error
FROM s LEFT JOIN f USING (src) LEFT JOIN b USING (src)""",
)
def source_report(spark, sf_dir):
    good, bad = collect.quarantine(mixed_bronze(spark, sf_dir))
    sources = spark.createDataFrame([("greenhouse",), ("lever",), ("remotive",), ("remoteok",), ("ashby",)], "source string")
    report = reports.source_report(collect.collect_bronze(good), bad, sources)
    return report.select("source", "ok", "fetched", F.coalesce("error", F.lit("")).alias("error"))


@query(
    "merge_board_lists",
    """WITH configured AS (SELECT 'lever' AS vendor, CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE lower(replace(s_name, '#', '-')) END AS slug,
  0 AS part, s_suppkey AS pos FROM supplier WHERE s_suppkey % 2 = 0),
discovered AS (SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'lever' ELSE 'ashby' END AS vendor,
  'supplier-' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS slug, 1 AS part, l_orderkey * 10 + l_linenumber AS pos FROM lineitem)
SELECT vendor, slug, arg_min(part, part * 1e15 + pos) AS part, arg_min(pos, part * 1e15 + pos) AS pos
FROM (SELECT * FROM configured UNION ALL SELECT * FROM discovered) WHERE slug <> '' GROUP BY vendor, slug""",
)
def merge_board_lists(spark, sf_dir):
    configured = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").selectExpr(
        "'lever' as vendor", "case when s_suppkey % 9 = 0 then '' else lower(replace(s_name, '#', '-')) end as slug", "s_suppkey as pos"
    )
    discovered = table(spark, sf_dir, "lineitem").selectExpr(
        "case when l_orderkey % 2 = 0 then 'lever' else 'ashby' end as vendor",
        "concat('supplier-', lpad(cast(l_suppkey as string), 9, '0')) as slug", "l_orderkey * 10 + l_linenumber as pos",
    )
    return collect.merge_board_lists(configured, discovered)
