import json
import sys
from datetime import date, datetime

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from siftwell.operators import candidates as ca
from siftwell.operators import evaluate as ev
from siftwell.operators import history, ledger, reports, routing, scoring, sinks
from siftwell.operators.answers import validate_answers
from siftwell.plans.actions import plan_actions
from siftwell.plans.daily import Web, run_daily
from siftwell.plans.evaluation import run_evaluation
from siftwell.schema import HISTORY, LEDGER, FilterRules, SelectionRules
from siftwell.sources import landing
from siftwell.sources.jsonld import BoardSite, board_frame
from siftwell.streaming import incremental

NOW = datetime(2024, 5, 15, 9)
PROMPT = scoring.Prompt("p", "Answer.", "Title: {title}\nat {company}")
# The scorers below run in Python workers, which cannot import a test module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.mark.parametrize(
    "reply, want",
    [
        ('{"eligible": true, "employmentType": "EOR", "confidence": 0.5, "reason": "r"}', (True, "eor", "", 0.5, "r")),
        ('text ```json\n{"eligible": false}\n``` more', (False, "unknown", "", 0.0, "")),
        ('sure: {"eligible": true, "confidence": 9}', (True, "unknown", "", 1.0, "")),
        ('{"eligible": true, "confidence": "0.25", "employmentType": "staff"}', (True, "unknown", "", 0.25, "")),
        ('{"eligible": "true"}', None),
        ('[{"eligible": true}]', None),
        ('{"eligible": true} {"eligible": true}', None),
        ("{'eligible': true}", None),
        ("nothing", None),
        (None, None),
    ],
)
def test_parse_classification(spark, reply, want):
    row = spark.createDataFrame([(reply,)], "x string").select(scoring.parse_classification(F.col("x")).alias("c")).first()["c"]
    assert (tuple(row) if row else None) == want


def test_prompt_fields_are_filled_in(spark):
    df = spark.createDataFrame([("C", "T {company}", None, "")], "company string, title string, location string, description string")
    prompt = scoring.Prompt("x", "", "{title}|{company}{company}|{location}|{description}|{other}")
    assert df.select(scoring.render_prompt(prompt).alias("p")).first()["p"] == "T {company}|CC|not given|not given|{other}"


def flaky(attempt):
    def score(system, user):
        title = user.split("Title: ")[1].split("\n")[0]
        if title == "down":
            raise RuntimeError("no model")
        if title == "late" and attempt < 2:
            return "hm", 5, 1
        return json.dumps({"eligible": True, "confidence": 0.9, "reason": title}), 5, 2

    return score


def jobs(spark, titles):
    rows = [(t, t, "C", "", "") for t in titles]
    return spark.createDataFrame(rows, "id string, title string, company string, location string, description string")


def test_score_batch_retries_counts_tokens_and_keeps_failures(spark):
    rows = {r["id"]: r for r in scoring.score_batch(jobs(spark, ["ok", "late", "down"]), flaky, PROMPT, backoff=0).collect()}
    assert (rows["ok"]["input_tokens"], rows["late"]["input_tokens"], rows["late"]["output_tokens"]) == (5, 15, 4)
    assert rows["down"]["failed"] and rows["down"]["classification"]["reason"] == "classification failed: no model"
    assert not rows["down"]["classification"]["eligible"]
    stats = scoring.score_stats(scoring.score_batch(jobs(spark, ["ok", "late", "down"]), flaky, PROMPT, backoff=0)).first()
    assert (stats["calls"], stats["failures"], stats["input_tokens"]) == (3, 1, 20)


def test_score_once_asks_only_for_what_is_missing(spark, tmp_path):
    path = str(tmp_path / "scores")
    scoring.score_once(jobs(spark, ["a", "b"]), flaky, PROMPT, path, backoff=0)

    def never(attempt):
        def score(system, user):
            assert "Title: c" in user
            return '{"eligible": false}', 1, 1

        return score

    out = scoring.score_once(jobs(spark, ["a", "b", "c"]), never, PROMPT, path, backoff=0)
    assert {r["id"]: r["classification"]["eligible"] for r in out.collect()} == {"a": True, "b": True, "c": False}


def test_failed_and_changed_postings_are_asked_again(spark, tmp_path):
    path = str(tmp_path / "scores")
    first = scoring.score_once(jobs(spark, ["a", "down"]), flaky, PROMPT, path, retries=0)
    assert {r["id"]: r["failed"] for r in first.collect()} == {"a": False, "down": True}

    def recovered(attempt):
        return lambda system, user: ('{"eligible": false, "reason": "second"}', 1, 1)

    again = jobs(spark, ["a", "down"]).withColumn("company", F.when(F.col("id") == "a", F.lit("D")).otherwise(F.col("company")))
    out = {r["id"]: r for r in scoring.score_once(again, recovered, PROMPT, path).collect()}
    assert out["a"]["classification"]["reason"] == out["down"]["classification"]["reason"] == "second"
    assert not out["down"]["failed"]


GOLD = "id string, job struct<source:string,company:string,title:string,location:string,url:string,description:string>, label struct<eligible:boolean,employment_type:string,note:string>"


def gold(spark, labels):
    return spark.createDataFrame([(i, ("s", "C", "T" + i, "", "u" + i, ""), (e, "b2b", None)) for i, e in labels], GOLD)


def predicted(spark, rows):
    schema = "id string, classification struct<eligible:boolean,employment_type:string,region_constraint:string,confidence:double,reason:string>"
    return spark.createDataFrame([(i, (e, t, "", 0.7, "r")) for i, e, t in rows], schema)


def test_metrics_count_a_missing_prediction_as_no(spark):
    joined = ev.join_predictions(
        gold(spark, [("1", True), ("2", True), ("3", False), ("4", False)]), predicted(spark, [("1", True, "b2b"), ("3", True, "eor"), ("4", False, "b2b")])
    )
    m = ev.metrics(joined).first()
    assert [m[c] for c in ("true_positives", "false_positives", "true_negatives", "false_negatives")] == [1, 1, 1, 1]
    assert (m["precision"], m["recall"], m["f1"], m["accuracy"], m["employment_type_accuracy"]) == (0.5, 0.5, 0.5, 0.5, 0.5)
    wrong = {r["id"]: r for r in ev.disagreements(joined).collect()}
    assert set(wrong) == {"2", "3"} and wrong["2"]["reason"] == "no prediction" and wrong["2"]["confidence"] == 0


def test_metrics_of_nothing_are_zero(spark):
    m = ev.metrics(ev.join_predictions(gold(spark, []), predicted(spark, []))).first()
    assert (m["total"], m["precision"], m["f1"], m["accuracy"]) == (0, 0, 0, 0)
    stats = ev.golden_stats(gold(spark, [])).first()
    assert stats["balanced"] is False and stats["total"] == 0


@pytest.mark.parametrize("eligible, balanced", [(5, True), (8, False), (7, True)])
def test_balance(spark, eligible, balanced):
    rows = [(str(i), i < eligible) for i in range(10)]
    assert ev.golden_stats(gold(spark, rows)).first()["balanced"] is balanced


def test_golden_lines_last_wins_and_bad_lines_are_named(spark):
    line = '{"id":"1","label":{"eligible":%s,"employment_type":"b2b"},"labelled_by":"x"}'
    good = spark.createDataFrame([(1, line % "true"), (2, ""), (3, line % "false")], "ord int, value string")
    assert [r["label"]["eligible"] for r in ev.parse_golden(good).collect()] == [False]
    with pytest.raises(Exception, match="line 2 is not valid JSON"):
        ev.parse_golden(spark.createDataFrame([(1, line % "true"), (2, "{")], "ord int, value string")).collect()


V1, V3 = (scoring.Prompt(v, "Answer.", "Title: {title}\n") for v in ("v1", "v3"))


def test_run_evaluation(spark, tmp_path):
    out = run_evaluation(gold(spark, [("1", True), ("2", False)]), [V1, V3], flaky, str(tmp_path), backoff=0)
    rows = {r["version"]: r for r in out.results.collect()}
    assert set(rows) == {"v1", "v3"} and rows["v1"]["calls"] == 2 and rows["v1"]["recall"] == 1
    assert out.disagreements.count() == 2
    with pytest.raises(ValueError):
        run_evaluation(gold(spark, []), [V1], flaky, str(tmp_path))


def test_history_never_moves_a_date(spark):
    known = spark.createDataFrame([("a", date(2024, 1, 1)), ("a", date(2024, 3, 1))], HISTORY)
    posts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "")], "ord bigint, url string")
    updated = {r["url"]: r["first_seen"] for r in history.update_first_seen(posts, known, NOW).collect()}
    assert updated == {"a": date(2024, 1, 1), "b": date(2024, 5, 15)}
    flags = {r["ord"]: r["is_new"] for r in history.mark_new(posts, known).collect()}
    assert flags == {1: False, 2: True, 3: True, 4: False}
    assert history.new_count(posts, known, NOW).first()[0] == 1
    assert {r["ord"]: r["age_days"] for r in history.with_age(posts, known, NOW).collect()}[1] == 135


def test_state_policies(spark, tmp_path):
    path = str(tmp_path / "state")
    assert sinks.load_state(spark, path, HISTORY).count() == 0
    sinks.append_state(spark.createDataFrame([("a", date(2024, 1, 1))], HISTORY), path)
    assert sinks.load_state(spark, path, HISTORY).first()["first_seen"] == date(2024, 1, 1)
    spark.createDataFrame([("{bad",)], "value string").write.mode("append").text(path)
    assert sinks.load_state(spark, path, HISTORY, on_corrupt="empty").count() == 0
    with pytest.raises(sinks.CorruptState):
        sinks.load_state(spark, path, HISTORY, on_corrupt="raise")


def test_a_damaged_state_heals(spark, tmp_path):
    root = str(tmp_path / "state")
    day = spark.createDataFrame([("a", date(2024, 1, 1))], HISTORY)
    rows, home = sinks.open_state(spark, root, HISTORY)
    assert rows.count() == 0
    sinks.append_state(day, home)
    spark.createDataFrame([("{bad",)], "value string").write.mode("append").text(home)
    rows, fresh = sinks.open_state(spark, root, HISTORY)
    assert rows.count() == 0 and fresh != home
    sinks.append_state(day, fresh)
    rows, again = sinks.open_state(spark, root, HISTORY)
    assert again == fresh and rows.count() == 1


def record(url, company="A", status="applied", at=NOW, **more):
    base = dict.fromkeys(LEDGER.names)
    return {**base, "url": url, "company": company, "title": "T", "lane": "ats", "status": status, "at": at, **more}


def log(spark, *records):
    return spark.createDataFrame([tuple(r.values()) for r in records], LEDGER).withColumn("ord", F.monotonically_increasing_id())


def test_ledger_parts_and_manual_marks(spark):
    rows = log(
        spark, record("u1", status="review", cover_note="hi", answers={"Rate": "5k"}), record("u1", status="failed"), record("u2", status="review", apply_url="f2")
    )
    current = ledger.latest_records(ledger.public_records(rows))
    assert "cover_note" not in current.columns
    merged = {r["url"]: r for r in ledger.with_private_notes(current, ledger.private_notes(rows)).collect()}
    assert merged["u1"]["status"] == "failed" and merged["u1"]["cover_note"] == "hi" and merged["u2"]["answers"] is None
    keys = spark.createDataFrame([("u1",), ("f2",), ("zzz",)], "key string")
    done, unknown = ledger.mark_done(ledger.latest_records(rows), keys, NOW)
    assert {(r["url"], r["status"], r["reason"]) for r in done.collect()} == {("u1", "applied", "applied manually"), ("u2", "applied", "applied manually")}
    assert [r["key"] for r in unknown.collect()] == ["zzz"]


def test_only_real_submissions_of_the_day_count(spark):
    rows = log(spark, record("a"), record("b", status="dry-run"), record("c", at=datetime(2024, 5, 14, 23)))
    assert ledger.submitted_on(rows, NOW).first()["submitted"] == 1
    assert ca.submission_budget(rows, SelectionRules(daily_cap=8), NOW).first()["budget"] == 7
    assert ca.submission_budget(rows, SelectionRules(daily_cap=0), NOW).first()["budget"] == 0


SCORED = "ord bigint, source string, company string, title string, location string, url string, posted_at timestamp, description string, classification struct<eligible:boolean,employment_type:string,region_constraint:string,confidence:double,reason:string>"


def scored(spark, *rows):
    full = []
    for i, (url, company, day, score) in enumerate(rows):
        c = {"eligible": True, "type": "b2b", "confidence": 0.9, **score}
        full.append((i, "lever", company, "T", "", url, datetime(2024, 5, day), "", (c["eligible"], c["type"], "", c["confidence"], "")))
    return spark.createDataFrame(full, SCORED)


def picked(spark, posts, records, seen=(), **rules):
    known = spark.createDataFrame(list(seen), HISTORY)
    return [r["url"] for r in ca.select_candidates(posts, log(spark, *records), known, SelectionRules(**rules), NOW).collect()]


def test_selection_gates(spark):
    posts = scored(
        spark, ("a1", "A", 1, {}), ("a2", "A", 2, {}), ("b", "B", 9, {"confidence": 0.5}), ("c", "C", 9, {"type": "payroll"}), ("d", "Old Co", 9, {}),
        ("e", "E", 3, {"eligible": False}), ("f", "F", 8, {}), ("g", "G", 7, {}), ("h", "H-1", 6, {}),
    )
    records = [record("z", company="old co", at=datetime(2024, 5, 1)), record("y", company="F", at=datetime(2024, 1, 1))]
    seen = [("g", date(2024, 5, 1)), ("f", date(2024, 5, 6))]
    assert picked(spark, posts, records, seen, exclude_companies=("h 1",)) == ["f", "a2"]


@pytest.mark.parametrize("day, status, expected", [(14, "failed", []), (10, "failed", ["a"]), (10, "review", []), (1, "dry-run", [])])
def test_only_old_failures_are_retried(spark, day, status, expected):
    records = [record("a", status=status, at=datetime(2024, 5, day))]
    assert picked(spark, scored(spark, ("a", "A", 1, {})), records) == expected


def test_routes(spark):
    rows = [
        ("mailto:x@y.example.com?subject=1", "", ("email", "x@y.example.com")),
        ("https://jobs.lever.co/a/1", "", ("ats", "https://jobs.lever.co/a/1/apply")),
        ("https://www.linkedin.com/jobs/1", "apply: a@b.example.com", ("review", "www.linkedin.com does not allow automated applications")),
        ("https://orbit.example.com/1", "apply: a@b.example.com", ("email", "a@b.example.com")),
        ("https://remoteok.com/1", "", ("resolve", None)),
        ("https://orbit.example.com/2", "", ("review", "unsupported application site (orbit.example.com)")),
        ("", "", ("review", "unsupported application site (no url)")),
    ]
    df = spark.createDataFrame([(i, u, d, "C", "s") for i, (u, d, _) in enumerate(rows)], "ord int, url string, description string, company string, source string")
    got = routing.with_route(df).orderBy("ord").select("route.*").collect()
    assert [(r["lane"], r["email"] or r["apply_url"] or r["reason"]) for r in got] == [w for _, _, w in rows]
    tried = routing.with_route(df, try_unknown_sites=True).orderBy("ord").select("route.*").collect()
    assert (tried[5]["lane"], tried[5]["ats"]) == ("ats", "generic") and tried[6]["lane"] == "review"


def test_plan_actions_resolves_aggregators(spark):
    posts = scored(spark, ("https://remoteok.com/1", "A", 1, {}), ("https://remotive.com/2", "B", 2, {}))
    pages = spark.createDataFrame([("https://remoteok.com/1", '<a href="/x">x</a><a href="https://jobs.lever.co/a/1">a</a>')], "url string, html string")
    plan = plan_actions(posts, log(spark, record("z", company="Z")), spark.createDataFrame([], HISTORY), SelectionRules(), NOW, pages)
    lanes = {r["company"]: (r["route"]["lane"], r["route"]["apply_url"] or r["route"]["reason"]) for r in plan.routed.collect()}
    assert lanes == {"A": ("ats", "https://jobs.lever.co/a/1/apply"), "B": ("review", routing.UNRESOLVED_REASON)}
    assert plan.budget == 7


def test_answers_must_be_offered(spark):
    q = "form_id int, id string, label string, name string, required boolean, options array<string>, max_length int"
    questions = spark.createDataFrame(
        [(1, "a", "Sponsor?", "n", True, ["Yes", "No"], None), (1, "b", "", "born", True, [], None), (1, "c", "Colour", "n", False, ["Red"], None), (1, "d", "Bio", "n", True, [], 3)], q
    )
    answers = spark.createDataFrame([(1, "a", [" no "]), (1, "c", ["Blue"]), (1, "d", ["", "long text"])], "form_id int, id string, answer array<string>")
    rows = {r["id"]: r for r in validate_answers(questions, answers).collect()}
    assert rows["a"]["accepted"] == ["No"] and rows["d"]["accepted"] == ["lon"]
    assert (rows["b"]["unanswered"], rows["c"]["unanswered"]) == ("born", None)


@pytest.mark.parametrize("ok, healthy", [([True, True, False], True), ([True, False], False), ([], False)])
def test_health_needs_more_than_half(spark, ok, healthy):
    report = spark.createDataFrame([(str(i), o) for i, o in enumerate(ok)], "source string, ok boolean")
    assert reports.run_health(report).first()["healthy"] is healthy
    if not healthy:
        with pytest.raises(reports.UnhealthyRun):
            reports.require_health(report)


def test_run_daily_end_to_end(spark, tmp_path):
    def job(i, title="Data Lead"):
        return {"title": title, "absolute_url": f"https://x.example.com/{i}", "updated_at": "2024-05-10", "location": {"name": "Remote"}}

    feed = {"jobs": [{"title": "Data Lead (Remote)", "company_name": "orbit", "url": "https://r.example.com/1", "candidate_required_location": "Remote"}]}
    rows = [
        ("greenhouse", "orbit", "", json.dumps({"jobs": [job(1), job(2, "Cook"), job(3, "Data Engineer")]}), 1),
        ("greenhouse", "lost", "", "{", 2),
        ("remotive", "", "", json.dumps(feed), 3),
    ]
    landed = str(tmp_path / "landed")
    landing.write_landed(spark.createDataFrame(rows, "source string, company string, url string, payload string, seq bigint"), landed)
    rules = FilterRules(["data"], ["intern"], ["remote"], ["us only"], 14)
    root = str(tmp_path / "out")
    run = run_daily(landing.read_landed(spark, landed), root, rules, NOW)
    totals = run.totals.first().asDict()
    assert totals == {"fetched": 4, "after_prefilter": 3, "after_dedupe": 2, "classified": 2, "eligible": 2, "new_since_last_run": 2}
    assert {r["source"]: r["error"] for r in run.sources.collect()} == {"greenhouse": "1 company slug(s) failed", "remotive": None}
    assert sorted(r["url"] for r in sinks.read_csv(spark, f"{root}/latest_csv").collect()) == ["https://x.example.com/1", "https://x.example.com/3"]
    digest = [r["value"] for r in spark.read.text(f"{root}/digest").collect()]
    assert digest[0] == "# Postings — 2024-05-15" and "0 new, 0 still open, 2 needing a look." in digest
    again = run_daily(landing.read_landed(spark, landed), root, rules, datetime(2024, 5, 16, 9))
    assert again.totals.first()["new_since_last_run"] == 0
    scored_run = run_daily(landing.read_landed(spark, landed), str(tmp_path / "scored"), rules, NOW, make_scorer=flaky, prompt=PROMPT)
    assert {r["classification"]["confidence"] for r in scored_run.scored.collect()} == {0.9}
    report = spark.read.json(str(tmp_path / "scored" / "run_report")).first()
    assert report["classifier"]["calls"] == 2 and report["finished_at"] > report["started_at"]
    assert {(r["source"], r["company"]) for r in run.failed_companies.collect()} == {("greenhouse", "lost")}


def test_daily_reads_boards_and_outlives_a_broken_source(spark, tmp_path):
    posting = {"@type": "JobPosting", "title": "Data Lead", "datePosted": "2024-05-10", "hiringOrganization": "Orbit"}
    html = f'<script type="application/ld+json">{json.dumps(posting)}</script>'
    pages = spark.createDataFrame([("https://board.example.com/jobs", html)], "url string, html string")
    boards = board_frame(spark, [BoardSite("job-boards", "https://board.example.com/jobs", "/job/")])
    broken = spark.range(1).select(F.raise_error(F.lit("no such feed")).cast("string").alias("domain"), F.lit(0).cast("long").alias("site"))
    rows = [("remotive", "", "", json.dumps({"jobs": [{"title": "Data Engineer", "company_name": "A", "url": "https://r.example.com/1"}]}), 1)]
    bronze = spark.createDataFrame(rows, "source string, company string, url string, payload string, seq bigint")
    run = run_daily(bronze, str(tmp_path / "out"), FilterRules(["data"]), NOW, web=Web(pages, sites=broken, boards=boards))
    assert {r["source"]: (r["ok"], r["fetched"]) for r in run.sources.collect()} == {
        "remotive": (True, 1), "job-boards": (True, 1), "company-sites": (False, 0),
    }
    assert sorted(r["title"] for r in run.scored.collect()) == ["Data Engineer", "Data Lead"]


def test_streaming_history_over_batches(spark, tmp_path):
    landing_dir, target, progress = (str(tmp_path / n) for n in ("in", "state", "progress"))
    schema = "url string, ts timestamp"

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(landing_dir)

    def run():
        stream = spark.readStream.schema(schema).json(landing_dir)
        incremental.stream_first_seen(stream, target, progress)
        return {r["url"]: str(r["first_seen"]) for r in incremental.first_seen_table(spark, target).collect()}

    land([("a", datetime(2024, 1, 2)), ("a", datetime(2024, 1, 3)), ("", datetime(2024, 1, 1))])
    assert run() == {"a": "2024-01-02"}
    land([("a", datetime(2024, 2, 1)), ("b", datetime(2024, 2, 1))])
    assert run() == {"a": "2024-01-02", "b": "2024-02-01"}
    land([("b", datetime(2024, 1, 15))])
    assert run() == {"a": "2024-01-02", "b": "2024-01-15"}
    # A lost checkpoint folder reads everything again and forgets nothing.
    progress = str(tmp_path / "progress2")
    land([("c", datetime(2024, 1, 9))])
    assert run() == {"a": "2024-01-02", "b": "2024-01-15", "c": "2024-01-09"}


def test_ingest_reads_every_file_once(spark, tmp_path):
    landing_dir, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for part in range(2):
        spark.range(part * 10, part * 10 + 10).repartition(3).write.mode("append").json(landing_dir)
        incremental.ingest(spark, landing_dir, "id bigint", lambda df: df.withColumn("twice", F.col("id") * 2), target, progress, files_per_batch=1)
    assert sorted(r["twice"] for r in spark.read.parquet(target).collect()) == [2 * i for i in range(20)]
