"""The daily run loses nothing: sites feed board lists, failures are named, rows are counted once."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siftwell.operators import prefilter, reports
from siftwell.plans.daily import Web, run_daily
from siftwell.schema import FilterRules
from siftwell.sources import jsonld, pagestore
from siftwell.operators.pages import page_key

NOW = datetime(2024, 5, 15, 9)
BRONZE = "source string, company string, url string, payload string, seq bigint"


def greenhouse(*titles):
    jobs = [{"title": t, "absolute_url": f"https://x.example.com/{t}", "updated_at": "2024-05-10"} for t in titles]
    return json.dumps({"jobs": jobs})


def site(spark):
    embed = '<script src="https://boards.greenhouse.io/embed/job_board/js?for=Revealed"></script>'
    pages = [
        ("https://acme.example.com", '<a href="/careers">c</a>'),
        ("https://acme.example.com/careers", embed),
        ("https://dull.example.com", '<a href="/jobs">j</a>'),
        ("https://dull.example.com/jobs", "<p>nothing here</p>"),
    ]
    sites = [(0, "acme.example.com"), (1, "dull.example.com"), (2, "gone.example.com")]
    return Web(spark.createDataFrame(pages, "url string, html string"), spark.createDataFrame(sites, "site bigint, domain string"))


def test_sites_decide_with_the_configuration_which_boards_are_read(spark, tmp_path, monkeypatch):
    rows = [
        ("greenhouse", "listed", "", greenhouse("Data A"), 1),
        ("greenhouse", "revealed", "", greenhouse("Data B", "Cook"), 2),
        ("greenhouse", "stranger", "", greenhouse("Data C"), 3),
        ("remotive", "", "", json.dumps({"jobs": [{"title": "Data D", "company_name": "O", "url": "https://r.example.com/1"}]}), 4),
    ]
    configured = [("greenhouse", "listed", 0), ("lever", "rotten", 1), ("greenhouse", "listed", 2), ("greenhouse", "", 3)]
    boards = spark.createDataFrame(configured, "vendor string, slug string, pos bigint")

    def again(*_):
        raise AssertionError("rows are counted while they are written")

    for name in ("run_totals", "source_report"):
        monkeypatch.setattr(reports, name, again)
    monkeypatch.setattr(prefilter, "drop_counts", again)
    rules = FilterRules(["data"], [], [], [], 14)
    run = run_daily(spark.createDataFrame(rows, BRONZE), str(tmp_path), rules, NOW, web=site(spark), boards=boards)
    assert sorted(r["title"] for r in run.scored.collect()) == ["Data A", "Data B", "Data D"]
    assert {(r["vendor"], r["slug"], r["landed"]) for r in run.boards.collect()} == {
        ("greenhouse", "listed", True), ("greenhouse", "revealed", True), ("lever", "rotten", False),
    }
    assert {(r["source"], r["company"]) for r in run.failed_companies.collect()} == {
        ("company-sites", "dull.example.com"), ("company-sites", "gone.example.com"), ("lever", "rotten"),
    }
    got = {r["source"]: (r["ok"], r["fetched"], r["error"]) for r in run.sources.collect()}
    assert got == {
        "company-sites": (True, 0, "2/3 site(s) gave nothing"), "greenhouse": (True, 3, None),
        "lever": (False, 0, "1 company slug(s) failed"), "remotive": (True, 1, None),
    }
    assert run.totals.first().asDict() == {
        "fetched": 4, "after_prefilter": 3, "after_dedupe": 3, "classified": 3, "eligible": 3, "new_since_last_run": 3,
    }
    assert {r["drop_reason"]: r["n"] for r in run.drop_counts.collect()}["no-keyword"] == 1
    for counted in (run.totals, run.drop_counts):
        assert "FileScan" not in counted._jdf.queryExecution().executedPlan().toString()
    kept = spark.read.json(f"{tmp_path}/boards")
    assert kept.count() == 3


def test_all_sites_failing_is_not_ok(spark):
    guards = spark.createDataFrame([("company-sites", True, 0, 1, None), ("lever", True, 0, 1, "down")], "source string, ok boolean, fetched bigint, duration_ms bigint, error string")
    lost = spark.createDataFrame([("company-sites", "a"), ("company-sites", "b"), ("company-sites", "b")], "source string, company string")
    got = {r["source"]: (r["ok"], r["error"]) for r in reports.landed_report(guards, lost, 2).collect()}
    assert got == {"company-sites": (False, "2/2 site(s) gave nothing"), "lever": (True, "down")}


@pytest.fixture
def store(spark, tmp_path):
    pages = [(f"https://s{i}.example.com/p/", f"<p>{i}</p>" if i else "") for i in range(50)]
    frame = spark.createDataFrame(pages, "url string, html string")
    return pagestore.write_page_store(frame, f"pages_{abs(hash(str(tmp_path)))}", str(tmp_path / "store"), 8), str(tmp_path / "store")


def test_a_page_store_joins_without_moving_html(spark, store):
    table, path = store
    asked = spark.createDataFrame([(i, f"https://s{i}.example.com/p") for i in range(0, 60, 2)], "n bigint, link string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = asked.select("n", page_key(F.col("link")).alias("key")).join(jsonld.landed(table), "key")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        # The only exchange moves the keys that are asked for: it lies before the second branch.
        pages_side = plan[plan.rindex("+- Sort") if "+- Sort" in plan else plan.rindex("+- *") :]
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        assert "FileScan" in pages_side and "Exchange" not in pages_side
        assert sorted(r["n"] for r in joined.collect()) == list(range(2, 50, 2))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_page_store_is_opened_again(spark, store):
    _, path = store
    again = pagestore.open_page_store(spark, f"again_{abs(hash(path))}", path, 8)
    assert again.count() == 49 and again.where("key = 'https://s7.example.com/p'").first()["html"] == "<p>7</p>"


NEEDLES = ["c++", "c#", "data", "data lead", "a.b", "[x]", "é", "né", "go", "golang", "ml ops", "\\d", "-", "z^", "kotlin", "ko", "rust", "ruby"]


@pytest.mark.parametrize("text", ["", "C++ dev", "a c# job", "golang", "aXb", "a.b", "[x", "[x]", "ne né", "kotlin", "\\d", "7", "x-y", "z^", "mlops ml  ops", "ru st"])
def test_many_keywords_are_found_as_few_are(one, text):
    needles = NEEDLES + [f"word{i}" for i in range(300)]
    low = text.lower()
    assert one(prefilter.contains_any(F.col("x"), needles), low) is any(n in low for n in needles)
    assert one(prefilter.contains_any(F.col("x"), [n.upper() for n in needles]), low) is any(n in low for n in needles)


def test_keywords_at_random(spark):
    import random

    rng = random.Random(5)
    needles = ["".join(rng.choice("abc.é") for _ in range(rng.randrange(2, 7))) for _ in range(60)]
    texts = ["".join(rng.choice("abc.é ") for _ in range(rng.randrange(0, 12))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "x string").select("x", prefilter.contains_any(F.col("x"), needles).alias("f"))
    assert all(r["f"] is any(n in r["x"] for n in needles) for r in df.collect())
    assert prefilter.any_of(["abc", "ab", "abd", "b"]) == "(?:ab|b)"
