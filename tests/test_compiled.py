"""Readers whose columns are compiled: no expression of theirs is interpreted for every row."""

import json

import pytest
from pyspark.sql import functions as F

from siftwell.functions.text import CUT_MARK, strip_html, with_plain_text
from siftwell.operators.pages import extract_jsonld, values_of
from siftwell.sources import boards, collect, jsonld

READ = ["greenhouse", "lever", "ashby", "workable", "recruitee", "personio", "remotive", "remoteok", "arbeitnow", "himalayas", "jobicy", "linkedin", "smartrecruiters"]


def landed(spark, source, payload):
    row = (source, "orbit", "", payload, 1)
    return spark.createDataFrame([row], "source string, company string, url string, payload string, seq bigint")


@pytest.fixture
def without_broadcasts(spark):
    """Joins as they are planned for large tables."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("source", READ)
def test_no_reader_binds_values_in_lambdas(spark, source):
    """A bound value (``let``) is a lambda, which Spark interprets for every row."""
    bronze = landed(spark, source, "")
    if source == "smartrecruiters":
        details = spark.createDataFrame([], "company string, id string, payload string")
        # The sections of a detail document are joined by a lambda.
        frame = boards.from_smartrecruiters(bronze, details).drop("description")
    else:
        frame = collect.READERS[source](bronze)
    if source == "personio":
        # So are the offices and parts of a position.
        frame = frame.drop("location", "description")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_fields_are_read_by_their_json_type(spark):
    """Elements that are no objects, fields of another type, nested fields of what is no object."""
    jobs = [
        7,
        None,
        {"title": 5, "location": "Oslo", "absolute_url": True, "updated_at": [1]},
        {"title": "a", "location": {"name": 3}, "absolute_url": "u", "updated_at": None, "first_published": "2024-05-01"},
        {"title": "b", "location": ["x"], "absolute_url": "v", "updated_at": False, "first_published": "2024-05-01", "content": {"x": 1}},
        {"title": "c", "absolute_url": "w", "updated_at": 1714521600},
    ]
    rows = collect.READERS["greenhouse"](landed(spark, "greenhouse", json.dumps({"jobs": jobs}))).orderBy("seq").collect()
    assert [(r["seq"], r["title"], r["location"], r["url"], str(r["posted_at"])[:10], r["description"]) for r in rows] == [
        (1000003, "a", "", "u", "2024-05-01", ""),
        (1000004, "b", "", "v", "None", ""),
        (1000005, "c", "", "w", "2024-05-01", ""),
    ]
    feed = [7, {}, {"company_name": "x", "salary": 5, "tags": "t"}, {"company_name": " ", "salary": " ", "tags": ["a", 1, None]}]
    rows = collect.READERS["remotive"](landed(spark, "remotive", json.dumps({"jobs": feed}))).orderBy("seq").collect()
    assert [(r["company"], r["salary"], r["tags"]) for r in rows] == [
        ("", None, None), ("", None, None), ("x", None, None), ("", None, ["a", "1", None])
    ]


TEXTS = {
    "a \n \n\n b": "a\n\nb",
    "a\t b  c\td": "a b c d",
    "x<BR />y</H3>z<i>w</i>": "x\ny\nz w",
    "&AMP;lt; &#39;&Rsquo;&LDQUO; &nbsp;.": "< ''\" .",
    "\n\n\n\nx &": "x &",
}


def test_plain_text_by_columns_is_that_of_the_expression(spark):
    rows = spark.createDataFrame([(k, v) for k, v in TEXTS.items()] + [(None, None)], "x string, y string")
    for r in with_plain_text(rows.select("x", "y", strip_html(F.col("x")).alias("e")), "x").collect():
        assert r["x"] == r["e"] == r["y"]
    cut = with_plain_text(spark.createDataFrame([("<b>abcdef</b>",)], "x string"), "x", limit=3).first()["x"]
    assert cut == "abc" + CUT_MARK


def test_details_are_shuffled_once(spark, without_broadcasts):
    """Texts of details are grouped by the key that postings are joined on."""
    details = spark.createDataFrame([("orbit", "1", "{}"), ("orbit", "1", "{}")], "company string, id string, payload string")
    bronze = landed(spark, "smartrecruiters", json.dumps({"content": [{"id": "1", "name": "React Lead"}]}))
    frame = boards.from_smartrecruiters(bronze, details)
    assert frame.count() == 1
    assert frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2


def objects(spark, *values):
    rows = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "seq bigint, j string")
    return rows.select(F.lit("s").alias("source"), F.lit("https://x.example/p").alias("page_url"), F.lit("F").alias("fallback_company"), "seq", F.try_parse_json("j").alias("o"))


def test_jsonld_objects_are_read_by_columns(spark):
    """Only lists (places, employment types) are left to lambdas."""
    frame = jsonld.from_jsonld(objects(spark, {})).select("seq", "company", "title", "url", "posted_at", "salary")
    assert "lambda" not in frame._jdf.queryExecution().optimizedPlan().toString()


PLACES = [
    None, "Oslo", 7, {}, {"name": "Hall"}, {"address": "Street 1"}, {"address": None, "name": "Hall"}, {"address": None, "addressLocality": "Riga"},
    {"address": {"addressLocality": 5, "addressCountry": {"name": "NO"}}}, {"address": {}, "name": "Hall"}, {"address": 3, "name": "Hall"}, {"address": ""},
    {"address": {"addressLocality": "", "addressCountry": "PL"}}, {"address": ["x"], "name": 4}, [], [{"name": "A"}, "B", None, {"address": {"addressCountry": "C"}}],
]
PAY = [
    None, 5, {}, {"value": 5}, {"value": {}}, {"value": {"minValue": 1, "maxValue": 2.5, "unitText": "HOUR"}, "currency": "EUR"}, {"value": {"minValue": 0, "maxValue": 2}},
    {"value": {"value": "0"}}, {"value": {"value": "", "minValue": 3}}, {"value": {"value": 3, "unitText": {"x": 1}}, "currency": ""}, {"value": {"maxValue": True, "minValue": [1]}},
]


def test_columns_read_what_expressions_read(spark):
    """Places and pay by columns are those of ``place_name`` and ``salary_text``, whatever the shape."""
    posting = {"@type": "JobPosting", "title": "t"}
    rows = objects(spark, *[{**posting, "jobLocation": p} for p in PLACES], *[{**posting, "baseSalary": p} for p in PAY])
    found = {r["seq"]: (r["location"], r["salary"]) for r in jsonld.from_jsonld(rows).collect()}
    names = F.filter(F.transform(values_of(F.expr("try_variant_get(o, '$.jobLocation', 'variant')")), jsonld.place_name), lambda n: n != "")
    pay = jsonld.salary_text(F.expr("try_variant_get(o, '$.baseSalary', 'variant')"))
    asked = {r["seq"]: (r["p"], r["s"]) for r in rows.select("seq", F.array_join(names, " / ").alias("p"), pay.alias("s")).collect()}
    assert found == asked
    assert found[len(PLACES) - 1][0] == "A / B / C" and found[len(PLACES) + 5][1] == "1-2.5 EUR per hour"


def test_types_of_employment_and_escaped_graphs(spark):
    posting = {"@type": "JobPosting", "title": "t"}
    kinds = [None, "A", 3, ["A", "B"], ["A", 2, 1.5, None], {"x": 1}, []]
    rows = jsonld.from_jsonld(objects(spark, *[{**posting, "employmentType": k} for k in kinds])).orderBy("seq").collect()
    assert [r["tags"] for r in rows] == [None, ["a"], ["3"], ["a", "b"], ["a", "2", "1.5", None], ['{"x":1}'], None]
    # A key may be written with escapes.
    block = '<script type="application/ld+json">{"\\u0040graph":[{"@type":"JobPosting"}]}</script>'
    assert extract_jsonld(spark.createDataFrame([(block,)], "html string"), postings_only=True).count() == 1


def test_candidates_are_shuffled_by_site_once(spark, without_broadcasts):
    """Candidates go to the store first; what was landed is ranked after one shuffle by site."""
    site = "https://www.orbit.example"
    home = '<a href="/jobs">a</a><a href="/jobs/">b</a><a href="/team">c</a>'
    pages = spark.createDataFrame([(f"{site}/", home), (f"{site}/jobs", "x"), (f"{site}/team", "y")], "url string, html string")
    frame = jsonld.career_pages(spark.createDataFrame([(1, "www.orbit.example")], "site bigint, domain string"), pages)
    assert [(r["page"], r["visit"]) for r in frame.orderBy("visit").collect()] == [(f"{site}/jobs", 1), (f"{site}/team", 2)]
    assert frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(site") == 1


def test_a_site_given_twice_names_its_pages_once(spark):
    site = "https://www.orbit.example"
    # Two landed pages of one key both count.
    pages = spark.createDataFrame([(f"{site}/", "h"), (f"{site}/jobs", "x"), (f"{site}/jobs/", "y")], "url string, html string")
    sites = spark.createDataFrame([(1, "www.orbit.example")] * 2, "site bigint, domain string")
    assert sorted((r["html"], r["visit"]) for r in jsonld.career_pages(sites, pages).select("html", "visit").collect()) in (
        [("x", 1), ("y", 2)], [("x", 2), ("y", 1)]
    )
