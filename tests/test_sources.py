import json

import pytest
from pyspark.sql import functions as F

from siftwell.operators import pages as pg
from siftwell.operators import robots as rb
from siftwell.schema import POSTING_COLUMNS
from siftwell.sources import boards, collect, feeds, jsonld

HTML = "<p>Build &amp; run</p>"


def bronze(spark, source, payload, company="orbit"):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    return spark.createDataFrame([(source, company, "", text, 1)], "source string, company string, url string, payload string, seq bigint")


DOCUMENTS = {
    "greenhouse": {"jobs": [{"title": "Data Lead", "location": {"name": "Remote"}, "absolute_url": "https://x.example.com/1", "updated_at": "2024-05-01T02:00:00+02:00", "content": HTML}, {"title": 5, "absolute_url": "https://x.example.com/2"}, 7]},
    "lever": [{"text": "Data Lead", "categories": {"location": "Oslo"}, "workplaceType": "remote", "applyUrl": "https://x.example.com/1", "createdAt": 1714521600000, "description": HTML}],
    "ashby": {"jobs": [{"title": "Data Lead", "isRemote": True, "location": "", "jobUrl": "https://x.example.com/1", "publishedAt": "2024-05-01", "descriptionHtml": HTML}]},
    "workable": {"jobs": [{"title": "Data Lead", "city": "Oslo", "country": "Norway", "telecommuting": True, "shortlink": "https://x.example.com/1", "created_at": "2024-05-01", "description": " ", "requirements": HTML}]},
    "recruitee": {"offers": [{"title": "Data Lead", "location": "Oslo", "remote": False, "careers_url": "https://x.example.com/1", "created_at": "2024-05-01 00:00:00 UTC", "description": HTML}]},
    "remotive": {"jobs": [{"company_name": "Orbit", "title": "Data Lead", "url": "https://x.example.com/1", "publication_date": "2024-05-01T00:00:00", "tags": ["a"], "description": HTML}]},
    "remoteok": [{"legal": "notice"}, {"id": "1", "position": "Data Lead", "company": "Orbit", "url": "https://x.example.com/1", "date": "2024-05-01T00:00:00+00:00", "salary_min": 0, "salary_max": 9, "description": HTML}],
    "arbeitnow": {"data": [{"company_name": "Orbit", "title": "Data Lead", "location": "Oslo", "remote": True, "url": "https://x.example.com/1", "created_at": 1714521600, "description": HTML}]},
    "himalayas": {"jobs": [{"companyName": "Orbit", "title": "Data Lead", "guid": "https://x.example.com/1", "pubDate": 1714521600, "minSalary": 1, "maxSalary": 2, "excerpt": HTML}]},
    "jobicy": {"jobs": [{"companyName": "Orbit", "jobTitle": "Data <i>Lead</i>", "url": "https://x.example.com/1", "pubDate": "2024-05-01 00:00:00", "jobDescription": HTML}]},
}


@pytest.mark.parametrize("source", sorted(DOCUMENTS))
def test_every_vendor_maps_to_one_schema(spark, source):
    read = collect.READERS[source]
    rows = read(bronze(spark, source, DOCUMENTS[source])).collect()
    assert len(rows) == 1
    row = rows[0]
    assert list(row.asDict()) == POSTING_COLUMNS
    assert row["title"] == "Data Lead"
    assert row["url"] == "https://x.example.com/1"
    assert row["posted_at"].isoformat() == "2024-05-01T00:00:00"
    assert row["description"] == "Build & run"


@pytest.mark.parametrize("source", sorted(DOCUMENTS))
def test_missing_fields_do_not_break_a_source(spark, source):
    empty = {"jobs": [{}], "offers": [{}], "data": [{}]}
    rows = collect.READERS[source](bronze(spark, source, [{}] if source in ("lever", "remoteok") else empty)).collect()
    boards_ = {"greenhouse", "lever", "ashby", "workable", "recruitee", "remoteok"}
    assert len(rows) == (0 if source in boards_ else 1)
    for row in rows:
        assert row["title"] == "" and row["url"] == "" and row["posted_at"] is None


def test_a_document_that_is_no_list_gives_nothing(spark):
    assert collect.READERS["lever"](bronze(spark, "lever", {"text": "Data Lead", "hostedUrl": "https://x.example.com"})).count() == 0
    assert collect.READERS["greenhouse"](bronze(spark, "greenhouse", {"jobs": "none"})).count() == 0
    assert collect.READERS["greenhouse"](bronze(spark, "greenhouse", "{")).count() == 0


def test_repeated_json_keys_take_the_last(spark):
    text = '{"jobs":[{"title":"a","title":"b","absolute_url":"https://x.example.com"}]}'
    assert [r["title"] for r in boards.from_greenhouse(bronze(spark, "greenhouse", text)).collect()] == ["b"]


def test_salaries_and_places(spark):
    rok = feeds.from_remoteok(bronze(spark, "remoteok", [{"id": 1, "position": "x", "salary_min": 10, "salary_max": 20}])).first()
    assert (rok["salary"], rok["location"]) == ("$10-$20", "Worldwide")
    him = feeds.from_himalayas(bronze(spark, "himalayas", DOCUMENTS["himalayas"])).first()
    assert (him["salary"], him["location"]) == ("1-2", "Worldwide")


def test_personio(spark):
    xml = (
        '<?xml version="1.0"?><workzag-jobs><position><id>42</id><name> Data Lead </name><office>Oslo</office>'
        "<employmentType>freelance</employmentType><createdAt>2024-05-01T00:00:00+00:00</createdAt><jobDescriptions><jobDescription>"
        "<name>Role</name><value><![CDATA[<p>Build</p>]]></value></jobDescription></jobDescriptions></position>"
        "<position><name>No id</name></position></workzag-jobs>"
    )
    rows = boards.from_personio_xml(bronze(spark, "personio", xml)).collect()
    assert [(r["title"], r["location"], r["url"]) for r in rows] == [("Data Lead", "Oslo", "https://orbit.jobs.personio.de/job/42")]
    assert rows[0]["description"] == "Employment type: freelance\nRole\nBuild"


def test_smartrecruiters_reads_details_for_plausible_titles_only(spark):
    listing = {"content": [{"id": i, "name": n, "location": {"city": "Dubai", "country": "ae", "remote": True}} for i, n in ((7, "React Lead"), (8, "Cook"))]}
    detail = json.dumps({"jobAd": {"sections": {"z": {"title": "T", "text": "<p>x</p>"}, "a": {"text": "y"}}}})
    details = spark.createDataFrame([("orbit", "7", detail), ("orbit", "8", detail)], "company string, id string, payload string")
    rows = {r["title"]: r for r in boards.from_smartrecruiters(bronze(spark, "smartrecruiters", listing), details).collect()}
    assert rows["React Lead"]["description"] == "T\nx\n\ny"
    assert rows["Cook"]["description"] == ""
    assert rows["Cook"]["url"] == "https://jobs.smartrecruiters.com/orbit/8"
    assert rows["Cook"]["location"] == "Dubai, AE, Remote"


def test_rss_splits_company_and_title(spark):
    xml = (
        "<rss><channel><item><title>Orbit: Data: Lead</title><link>https://x.example.com/1</link><pubDate>Wed, 01 May 2024 10:00:00 +0000</pubDate>"
        "<description>&lt;p&gt;Build&lt;/p&gt;</description></item></channel></rss>"
    )
    row = feeds.from_rss(bronze(spark, "weworkremotely", xml)).first()
    assert (row["company"], row["title"], row["location"], row["description"]) == ("Orbit", "Data: Lead", "Remote", "Build")
    assert row["posted_at"].isoformat() == "2024-05-01T10:00:00"


def test_cards_go_by_position(spark):
    card = '<a class="base-card__full-link" href="https://x.example.com/{0}?t=1"><span class="sr-only"> Role {0} </span></a>'
    html = card.format(1) + '<h4 class="base-search-card__subtitle"><a href="#">Orbit</a></h4>' + card.format(2)
    rows = feeds.from_linkedin_cards(bronze(spark, "linkedin", html)).orderBy("seq").collect()
    assert [(r["title"], r["company"], r["location"], r["url"]) for r in rows] == [
        ("Role 1", "Orbit", "Remote", "https://x.example.com/1"), ("Role 2", "", "Remote", "https://x.example.com/2"),
    ]


def test_quarantine_splits_bad_documents(spark):
    good = bronze(spark, "greenhouse", {"jobs": []})
    bad = bronze(spark, "greenhouse", '{"jobs": []} trailing').unionByName(bronze(spark, "personio", "<html/>")).unionByName(bronze(spark, "lever", " "))
    rss = "<rss><channel><item><title>A: B</title></item>"
    cut = bronze(spark, "weworkremotely", rss).unionByName(bronze(spark, "weworkremotely", rss + "<item></channel></rss>"))
    whole = bronze(spark, "weworkremotely", rss + "</channel></rss>\n").unionByName(bronze(spark, "personio", "<workzag-jobs/>"))
    ok, failed = collect.quarantine(good.unionByName(bad).unionByName(cut).unionByName(whole))
    assert ok.count() == 3
    assert sorted(r["error"] for r in failed.collect()) == [
        "cut-off XML", "damaged XML", "empty payload", "not the expected XML", "not valid JSON",
    ]


def test_smartrecruiters_without_details_keeps_its_postings(spark):
    feed = bronze(spark, "smartrecruiters", {"content": [{"id": "1", "name": "React dev"}]})
    rows = collect.collect_bronze(feed).collect()
    assert [(r["title"], r["description"]) for r in rows] == [("React dev", "")]
    twice = spark.createDataFrame([(feed.first()["company"], "1", '{"jobAd": {"sections": {"a": {"title": "T", "text": "x"}}}}')] * 2, "company string, id string, payload string")
    assert [r["description"] for r in collect.collect_bronze(feed, twice).collect()] == ["T\nx"]


def page(spark, html, url="https://www.orbit.example.com/a/b"):
    return spark.createDataFrame([(1, url, html)], "page_id bigint, url string, html string")


POSTING = {
    "@type": "JobPosting", "title": "Data Lead", "datePosted": "2024-05-01", "employmentType": ["CONTRACTOR"], "jobLocationType": "TELECOMMUTE",
    "applicantLocationRequirements": {"name": "Georgia"}, "hiringOrganization": "Orbit", "description": "<p>B2B</p>",
    "jobLocation": {"address": {"addressLocality": "Oslo", "addressCountry": "NO"}},
    "baseSalary": {"currency": "EUR", "value": {"minValue": 310, "maxValue": 415.5, "unitText": "MONTH"}},
}


def script(value):
    return f'<SCRIPT id="x" type="application/ld+json">{value if isinstance(value, str) else json.dumps(value)}</SCRIPT>'


def test_jsonld_is_walked_breadth_first_past_broken_blocks(spark):
    deep = {"@type": "ItemList", "itemListElement": [{"item": {"n": 2, "@graph": [{"n": 4}]}}, {"n": 3}], "n": 1}
    html = script("{ broken") + script(deep) + script([{"n": 5}, 6, None]) + script("<!-- {\"n\": 7} -->")
    found = [r["n"] for r in pg.extract_jsonld(page(spark, html)).orderBy("pos").select(F.expr("try_variant_get(o, '$.n', 'int')").alias("n")).collect()]
    assert found == [1, 2, 3, 4, 5, 7]


def test_jsonld_nesting_has_no_depth_limit(spark):
    value = POSTING
    for _ in range(40):
        value = {"@graph": [value]}
    assert pg.extract_jsonld(page(spark, script(value)), postings_only=True).count() == 1


def test_jsonld_posting_fields(spark):
    items = pg.extract_jsonld(page(spark, script({"@graph": [{"@type": "Organization"}, POSTING]})))
    items = items.select(F.col("url").alias("page_url"), F.lit("s").alias("source"), F.lit("F").alias("fallback_company"), F.lit(0).alias("seq"), "o")
    row = jsonld.from_jsonld(items).collect()
    assert len(row) == 1
    assert row[0]["location"] == "Remote / Georgia / Oslo, NO"
    assert row[0]["salary"] == "310-415.5 EUR per month"
    assert row[0]["company"] == "Orbit"
    assert row[0]["url"] == "https://www.orbit.example.com/a/b"
    assert row[0]["description"] == "Employment type: CONTRACTOR\nApplicants must be located in: Georgia\nB2B"


def test_links_are_resolved_once_each(spark):
    html = """<a href="/x">1</a><a href='https://www.orbit.example.com/x'>2</a><a href="c?a=1&amp;b=2">3</a><a href="#t">4</a><a href="mailto:a@b.c">5</a>"""
    assert [r["link"] for r in pg.extract_links(page(spark, html)).orderBy("pos").collect()] == [
        "https://www.orbit.example.com/x", "https://www.orbit.example.com/a/c?a=1&b=2",
    ]


def test_boards_are_discovered(spark):
    html = '<iframe src="https://job-boards.greenhouse.io/embed/job_board?for=orbit"></iframe> https://jobs.lever.co/orbit-labs/1 https://boards.greenhouse.io/Orbit https://apply.workable.com/api/x //orbit.jobs.personio.de https://jobs.ashbyhq.com/bad%zz'
    found = {(r["vendor"], r["slug"]) for r in pg.discover_ats(page(spark, html)).collect()}
    assert found == {("greenhouse", "orbit"), ("lever", "orbit-labs"), ("personio", "orbit"), ("ashby", "bad%zz")}


def test_robots_rules(spark):
    txt = "User-agent: Googlebot\nDisallow: /\n\nUser-agent: a\nUser-agent: *\nDisallow: /vault # x\nAllow: /vault/y\nDisallow:\nDisallow: /find*by=\nUser-agent: b\nDisallow: /b"
    row = spark.createDataFrame([(txt,)], "t string").select(rb.parse_robots(F.col("t")).alias("r")).first()
    assert row["r"] == ["/vault", "/find*by="]
    rules = spark.createDataFrame([(row["r"],)], "r array<string>")
    hit = rules.select(*[rb.blocked(F.col("r"), F.lit(p)).alias(str(i)) for i, p in enumerate(["/about", "/vault/x", "/find-by=1", "/x/vault"])]).first()
    assert list(hit) == [False, True, True, False]


def test_company_site_from_home_to_postings(spark):
    site = "https://www.orbit.example.com"
    rows = [
        (1, f"{site}/", '<a href="/team/">t</a><a href="https://else.example.com/jobs">e</a> https://jobs.lever.co/orbit'),
        (2, f"{site}/team", '<a href="/jobs/lead">l</a><a href="/team/">self</a>' + script({**POSTING, "title": "Inline"})),
        (3, f"{site}/jobs", '<a href="/jobs/lead">l</a><a href="/jobs/second">s</a>'),
        (4, f"{site}/jobs/lead", script(POSTING)),
        (5, f"{site}/jobs/second", script({**POSTING, "title": ""})),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    sites = spark.createDataFrame([(0, "www.orbit.example.com"), (1, "gone.example.com")], "site bigint, domain string")
    got = jsonld.from_company_sites(sites, pages)
    assert [r["title"] for r in got.postings.orderBy("seq").collect()] == ["Inline", "Data Lead"]
    assert [(r["vendor"], r["slug"]) for r in got.discovered.collect()] == [("lever", "orbit")]
    assert [(r["company"], r["error"]) for r in got.failed.collect()] == [("gone.example.com", jsonld.NO_HOME_PAGE)]


def test_board_listing_caps_its_links(spark):
    listing = script({**POSTING, "title": "Inline"}) + "".join(f'<a href="/offer/{i}">o</a>' for i in range(5)) + '<a href="/other">x</a>'
    rows = [(0, "https://b.example.com/list", listing)] + [(i + 1, f"https://b.example.com/offer/{i}", script({**POSTING, "title": f"T{i}"})) for i in range(5)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    frame = jsonld.board_frame(spark, [jsonld.BoardSite("board", "https://b.example.com/list", "/offer/", 2)])
    assert [r["title"] for r in jsonld.from_board_listing(frame, pages).orderBy("seq").collect()] == ["Inline", "T0", "T1"]
    assert jsonld.BoardSite("b", "u", "(").pattern() == r"(?i)\Q(\E"
