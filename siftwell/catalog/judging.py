"""Prompts, replies, batch scoring, answer checks and scorer evaluation."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.catalog.inputs import table
from siftwell.catalog.registry import query
from siftwell.operators import answers as an
from siftwell.operators import evaluate as ev
from siftwell.operators import prefilter, reports, scoring, sinks
from siftwell.runtime import scratch

SHORT = scoring.Prompt("short", scoring.ANSWER, "Role: {title}\nAt: {company}\nWhere: {location}\n")
FULL = scoring.Prompt("full", scoring.ANSWER, SHORT.user + "Text:\n{description}")


def doc_postings(spark, sf_dir) -> DataFrame:
    """Documents as postings."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        "doc_id",
        "source",
        F.concat(F.lit("Company "), F.col("doc_id") % 50).alias("company"),
        F.concat(F.lit("Role in "), F.col("lang")).alias("title"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("lang")).alias("location"),
        F.when(F.col("doc_id") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("https://docs.example.com/"), F.col("doc_id"))).alias("url"),
        F.when(F.col("doc_id") % 5 == 0, F.lit("")).otherwise(F.col("text")).alias("description"),
        F.lit(None).cast("timestamp").alias("posted_at"),
        "n_chars",
    )


def _prompt_sql(described: bool) -> str:
    body = "|| 'Text:' || chr(10) || CASE WHEN doc_id % 5 = 0 OR text = '' THEN 'not given' ELSE text END" if described else ""
    return f"""'Role: Role in ' || lang || chr(10) || 'At: Company ' || doc_id % 50 || chr(10)
  || 'Where: ' || CASE WHEN doc_id % 3 = 0 THEN 'not given' ELSE lang END || chr(10) {body}"""


@query("render_prompt", f"SELECT doc_id, md5({_prompt_sql(False)}) AS short, md5({_prompt_sql(True)}) AS \"full\" FROM documents")
def render_prompt(spark, sf_dir):
    docs = doc_postings(spark, sf_dir)
    return docs.select("doc_id", *[F.md5(scoring.render_prompt(p)).alias(p.version) for p in (SHORT, FULL)])


# Replies a model may give, by document.
REPLY = """case doc_id % 12
 when 0 then concat('{"eligible": true, "employmentType": "B2B", "regionConstraint": "EU", "confidence": 0.', doc_id % 10, ', "reason": "r', doc_id, '"}')
 when 1 then concat('Sure:\\n```json\\n{"eligible": false, "confidence": "0.5", "reason": "fence"}\\n``` done')
 when 2 then concat('I think {"eligible": true, "confidence": 7, "employmentType": "contract"} is right')
 when 3 then '{"eligible": "true", "confidence": 1}' when 4 then 'no idea' when 5 then '{"eligible": true, "confidence": null, "reason": null}'
 when 6 then '{"eligible": true} and {"eligible": false}' when 7 then '[{"eligible": true}]' when 8 then '```\\n{"eligible": true, "confidence": -1}```'
 when 9 then '{"eligible": false, "eligible": true, "confidence": true}' when 10 then '  {"eligible": true, "confidence": "high", "regionConstraint": 5}  '
 else '{"eligible": 1}' end"""


@query(
    "parse_response",
    """SELECT doc_id, CASE doc_id % 12 WHEN 0 THEN 'true|b2b|EU|0.' || doc_id % 10 || '|r' || doc_id WHEN 1 THEN 'false|unknown||0.5|fence'
  WHEN 2 THEN 'true|unknown||1.0|' WHEN 5 THEN 'true|unknown||0.0|' WHEN 8 THEN 'true|unknown||0.0|' WHEN 9 THEN 'true|unknown||1.0|'
  WHEN 10 THEN 'true|unknown|5|0.0|' ELSE 'failed' END AS parsed FROM documents""",
)
def parse_response(spark, sf_dir):
    """Bare objects, fences, prose around an object, wrong types, double keys, no object."""
    replies = table(spark, sf_dir, "documents").select("doc_id", scoring.parse_classification(F.expr(REPLY)).alias("c"))
    fields = ["eligible", "employment_type", "region_constraint", "confidence", "reason"]
    line = F.concat_ws("|", *[F.col(f"c.{f}").cast("string") for f in fields])
    return replies.select("doc_id", F.when(F.col("c").isNull(), F.lit("failed")).otherwise(line).alias("parsed"))


def length_scorer(attempt: int):
    """A scorer that judges by the length of the prompt; it fails on some prompts, on others at first."""

    def score(system: str, user: str) -> tuple[str, int, int]:
        n = len(user)
        if n % 11 == 0:
            raise RuntimeError("model unavailable")
        if n % 7 == 0 and attempt == 0:
            return "let me think", n, 1
        kind = ["b2b", "eor", "payroll", "unknown"][n % 4]
        reply = {"eligible": n % 2 == 0, "employmentType": kind, "confidence": (n % 10) / 10, "reason": f"n={n}"}
        return json.dumps(reply), n, 10

    return score


SCORE_SQL = f"""p AS (SELECT doc_id, n_chars, text, length({_prompt_sql(True)}) AS n FROM documents),
scores AS (SELECT doc_id, n, n % 11 = 0 AS failed, n % 11 <> 0 AND n % 2 = 0 AS eligible,
  CASE WHEN n % 11 = 0 THEN 'unknown' ELSE ['b2b', 'eor', 'payroll', 'unknown'][n % 4 + 1] END AS employment_type,
  CASE WHEN n % 11 = 0 THEN 0.0 ELSE (n % 10) / 10.0 END AS confidence,
  CASE WHEN n % 11 = 0 THEN 'classification failed: model unavailable' ELSE 'n=' || n END AS reason,
  CASE WHEN n % 11 = 0 THEN 0 WHEN n % 7 = 0 THEN 2 * n ELSE n END AS input_tokens,
  CASE WHEN n % 11 = 0 THEN 0 WHEN n % 7 = 0 THEN 11 ELSE 10 END AS output_tokens FROM p)"""


def scored_docs(spark, sf_dir) -> DataFrame:
    path = f"{scratch(spark)}/scores"
    return scoring.score_once(doc_postings(spark, sf_dir), length_scorer, FULL, path, parallelism=8, backoff=0.0)


@query(
    "score_batch",
    f"WITH {SCORE_SQL} SELECT doc_id::VARCHAR AS id, eligible, employment_type, confidence, reason, input_tokens, output_tokens, failed FROM scores",
)
def score_batch(spark, sf_dir):
    """Scoring with retries; failed rows are kept and say why. Written once, then read."""
    return scored_docs(spark, sf_dir).select(
        "id", "classification.eligible", "classification.employment_type", "classification.confidence", "classification.reason",
        "input_tokens", "output_tokens", "failed",
    )


def recovered_scorer(attempt: int):
    """The same model, no longer unavailable."""

    def score(system: str, user: str) -> tuple[str, int, int]:
        n = len(user)
        return json.dumps({"eligible": n % 2 == 0, "confidence": 0.5, "reason": f"again {n}"}), n, 10

    return score


@query(
    "score_retry",
    f"""WITH {SCORE_SQL} SELECT doc_id::VARCHAR AS id, n % 2 = 0 AS eligible,
  CASE WHEN failed THEN 'again ' || n ELSE 'n=' || n END AS reason, false AS failed FROM scores""",
)
def score_retry(spark, sf_dir):
    """Two runs over one score table: the second asks only for what failed in the first."""
    path = f"{scratch(spark)}/scores"
    postings = doc_postings(spark, sf_dir)
    scoring.score_once(postings, length_scorer, FULL, path, parallelism=8, backoff=0.0)
    scores = scoring.score_once(postings, recovered_scorer, FULL, path, parallelism=8, backoff=0.0)
    return scores.select("id", "classification.eligible", "classification.reason", "failed")


@query(
    "score_stats",
    f"""WITH {SCORE_SQL}, s AS (SELECT count(*) AS calls, count(*) FILTER (failed) AS failures, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
  CAST(sum(output_tokens) AS BIGINT) AS output_tokens FROM scores)
SELECT *, input_tokens / 1e6 * 0.15 + output_tokens / 1e6 * 0.6 AS cost_usd,
  (input_tokens / 1e6 * 0.15 + output_tokens / 1e6 * 0.6) / calls * 1000 AS cost_per_1k_usd FROM s""",
)
def score_stats(spark, sf_dir):
    return scoring.score_stats(scored_docs(spark, sf_dir))


@query("score_disabled", "SELECT doc_id, true AS eligible, 'unknown' AS employment_type, CAST(0 AS DOUBLE) AS confidence, 'classifier disabled' AS reason FROM documents")
def score_disabled(spark, sf_dir):
    return scoring.score_disabled(doc_postings(spark, sf_dir)).select(
        "doc_id", "classification.eligible", "classification.employment_type", "classification.confidence", "classification.reason"
    )


QUESTIONS = """SELECT conv_id AS form_id, turn AS id, role, text, turn % 3 AS k, length(text) AS n FROM conversations"""


@query(
    "validate_answers",
    f"""WITH q AS ({QUESTIONS})
SELECT form_id, id, CASE WHEN k = 0 THEN CASE WHEN n % 4 = 0 THEN 'Yes|Not now' WHEN n % 4 = 1 THEN 'No' ELSE '' END
    WHEN k = 1 THEN CASE WHEN n % 5 = 0 THEN '' ELSE substr(trim(replace(text, chr(10), ' ')), 1, 12) END ELSE trim(role) END AS accepted,
  CASE WHEN (k = 0 AND n % 4 > 1) OR (k = 1 AND n % 5 = 0) THEN CASE WHEN n % 2 = 0 THEN 'label ' || id ELSE 'name ' || id END ELSE '' END AS unanswered FROM q""",
)
def validate_answers(spark, sf_dir):
    """Turns as form questions: options, a length limit, blanks, missing answers."""
    q = table(spark, sf_dir, "conversations").selectExpr(
        "conv_id as form_id", "turn as id", "role", "text", "turn % 3 as k", "length(text) as n"
    )
    questions = q.select(
        "form_id", "id",
        F.expr("case when n % 2 = 0 then concat('label ', id) else '' end").alias("label"),
        F.expr("concat('name ', id)").alias("name"),
        (F.col("k") < 2).alias("required"),
        F.expr("case when k = 0 then array('Yes', 'No', 'Not now') else array() end").cast("array<string>").alias("options"),
        F.expr("case when k = 1 then 12 end").alias("max_length"),
    )
    given = q.where("not (k = 0 and n % 4 = 3)").select(
        "form_id", "id",
        F.expr(
            """case when k = 0 then case n % 4 when 0 then array(' yes', 'not n', 'maybe later') when 1 then array('NO') else array('maybe later') end
               when k = 1 then case when n % 5 = 0 then array('  ') else array(replace(text, '\\n', ' ')) end else array(concat(' ', role)) end"""
        ).alias("answer"),
    )
    checked = an.validate_answers(questions, given)
    return checked.select("form_id", "id", F.array_join("accepted", "|").alias("accepted"), F.coalesce("unanswered", F.lit("")).alias("unanswered"))


# Golden set: labelled documents. Predictions by a length rule per version; some are withheld.
GOLD_SQL = """g AS (SELECT d.doc_id, quality = 1 AS eligible, CASE toxic WHEN 1 THEN 'payroll' ELSE 'b2b' END AS employment_type, n_chars, lang
  FROM labels JOIN documents d USING (doc_id)),
pr AS (SELECT v.version, g.doc_id, n_chars > v.cut AS p, CASE WHEN n_chars % 3 = 0 THEN 'payroll' ELSE 'b2b' END AS ptype,
  (n_chars % 10) / 10.0 AS confidence FROM g, (VALUES ('v1', 400), ('v2', 1000), ('v3', 2500)) v(version, cut) WHERE g.doc_id % 9 <> 4),
j AS (SELECT v.version, g.*, coalesce(pr.p, false) AS p, pr.ptype, pr.confidence FROM g CROSS JOIN (VALUES ('v1'), ('v2'), ('v3')) v(version)
  LEFT JOIN pr ON pr.version = v.version AND pr.doc_id = g.doc_id),
m AS (SELECT version, count(*) FILTER (eligible AND p) AS tp, count(*) FILTER (NOT eligible AND p) AS fp,
  count(*) FILTER (NOT eligible AND NOT p) AS tn, count(*) FILTER (eligible AND NOT p) AS fn, count(*) AS total,
  count(*) FILTER (ptype = employment_type) AS tm FROM j GROUP BY version)"""
CUTS = {"v1": 400, "v2": 1000, "v3": 2500}


def golden(spark, sf_dir) -> DataFrame:
    docs = doc_postings(spark, sf_dir)
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id").select(
        "id",
        F.struct("source", "company", "title", "location", "url", "posted_at", "description").alias("job"),
        F.struct(
            (F.col("quality") == 1).alias("eligible"),
            F.when(F.col("toxic") == 1, F.lit("payroll")).otherwise(F.lit("b2b")).alias("employment_type"),
            F.concat(F.lit("note "), F.col("doc_id")).alias("note"),
        ).alias("label"),
        "n_chars",
        "doc_id",
    )


def predictions(gold: DataFrame, versions: list[str]) -> DataFrame:
    """One prediction per record and version, as a scorer would leave them."""
    cuts = F.create_map(*[F.lit(x) for v in versions for x in (v, CUTS[v])])
    rows = gold.where("doc_id % 9 <> 4").withColumn("version", F.explode(F.array(*[F.lit(v) for v in versions])))
    return rows.select(
        "version",
        "id",
        F.struct(
            (F.col("n_chars") > cuts[F.col("version")]).alias("eligible"),
            F.when(F.col("n_chars") % 3 == 0, F.lit("payroll")).otherwise(F.lit("b2b")).alias("employment_type"),
            ((F.col("n_chars") % 10) / 10).alias("confidence"),
            F.concat(F.lit("chars "), F.col("n_chars")).alias("reason"),
        ).alias("classification"),
    )


def judged(spark, sf_dir, versions: list[str]) -> DataFrame:
    gold = golden(spark, sf_dir)
    per_version = gold.withColumn("version", F.explode(F.array(*[F.lit(v) for v in versions])))
    return ev.join_predictions(per_version, predictions(gold, versions), ["version", "id"])


@query("eval_confusion", f"WITH {GOLD_SQL} SELECT tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives FROM m WHERE version = 'v2'")
def eval_confusion(spark, sf_dir):
    return ev.confusion(judged(spark, sf_dir, ["v2"]))


METRICS_SQL = """total, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
  coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1, coalesce((tp + tn) / nullif(total, 0), 0.0) AS accuracy,
  coalesce(tm / nullif(total, 0), 0.0) AS employment_type_accuracy"""
METRIC_COLUMNS = ["total", "precision", "recall", "f1", "accuracy", "employment_type_accuracy"]


def rounded(df: DataFrame) -> DataFrame:
    for c in METRIC_COLUMNS[1:]:
        df = df.withColumn(c, F.round(c, 9))
    return df


def _rounded_sql(select: str) -> str:
    return "SELECT * REPLACE (" + ", ".join(f"round({c}, 9) AS {c}" for c in METRIC_COLUMNS[1:]) + f") FROM ({select})"


@query("eval_metrics", f"WITH {GOLD_SQL} " + _rounded_sql(f"SELECT {METRICS_SQL} FROM m WHERE version = 'v2'"))
def eval_metrics(spark, sf_dir):
    return rounded(ev.metrics(judged(spark, sf_dir, ["v2"])).select(*METRIC_COLUMNS))


@query("eval_versions", f"WITH {GOLD_SQL} " + _rounded_sql(f"SELECT version, {METRICS_SQL} FROM m"))
def eval_versions(spark, sf_dir):
    """Three versions on one golden set."""
    return rounded(ev.metrics(judged(spark, sf_dir, ["v1", "v2", "v3"]), ["version"]).select("version", *METRIC_COLUMNS))


@query(
    "eval_disagreements",
    f"""WITH {GOLD_SQL} SELECT doc_id::VARCHAR AS id, 'Role in ' || lang AS title, eligible AS expected, p AS predicted,
  coalesce(confidence, 0.0) AS confidence, CASE WHEN ptype IS NULL THEN 'no prediction' ELSE 'chars ' || n_chars END AS reason,
  'note ' || doc_id AS note FROM j WHERE version = 'v2' AND eligible <> p""",
)
def eval_disagreements(spark, sf_dir):
    wrong = ev.disagreements(judged(spark, sf_dir, ["v2"]))
    return wrong.select("id", "title", "expected", "predicted", "confidence", "reason", "note")


@query(
    "disagreements_top",
    f"""WITH {GOLD_SQL}, w AS (SELECT doc_id::VARCHAR AS id, eligible AS expected, p AS predicted FROM j WHERE version = 'v2' AND eligible <> p)
SELECT * FROM w ORDER BY id LIMIT 15""",
)
def disagreements_top(spark, sf_dir):
    """The fifteen wrong cases that a report lists."""
    wrong = ev.listed_disagreements(ev.disagreements(judged(spark, sf_dir, ["v2"])))
    return wrong.select("id", "expected", "predicted")


PCT_SQL = ", ".join(
    f"printf('%.1f%%', {c} * 100) AS {c}" for c in ("precision", "recall", "f1", "accuracy", "employment_type_accuracy")
)


@query(
    "eval_report",
    f"""WITH {GOLD_SQL}, s AS (SELECT version, tp, fp, tn, fn, {METRICS_SQL} FROM m),
t AS (SELECT version, tp, fp, tn, fn, total, {PCT_SQL} FROM s)
SELECT version, concat_ws(chr(10), 'prompt ' || version || ' on fixed/rule',
    '  n=' || total || '  precision=' || precision || '  recall=' || recall || '  F1=' || f1,
    '  accuracy=' || accuracy || '  employment-type accuracy=' || employment_type_accuracy,
    '  TP=' || tp || ' FP=' || fp || ' TN=' || tn || ' FN=' || fn,
    '  0 call failures, $1.2500 spent, $0.05 per 1000 postings') AS text,
  '| ' || version || ' | rule | ' || total || ' | ' || precision || ' | ' || recall || ' | ' || f1 || ' | $0.05 |' AS markdown FROM t""",
)
def eval_report(spark, sf_dir):
    """The text block and the markdown row per version."""
    m = ev.metrics(judged(spark, sf_dir, ["v1", "v2", "v3"]), ["version"])
    bill = m.select("*", F.lit("fixed").alias("provider"), F.lit("rule").alias("model"), F.lit(0).alias("failures"), F.lit(1.25).alias("cost_usd"), F.lit(0.05).alias("cost_per_1k_usd"))
    return ev.metric_text(bill).select("version", "text", "markdown")


@query(
    "golden_stats",
    f"""WITH {GOLD_SQL}, s AS (SELECT count(*) AS total, count(*) FILTER (eligible) AS eligible, count(*) FILTER (employment_type = 'b2b') AS n_b2b,
  count(*) FILTER (employment_type = 'payroll') AS n_payroll FROM g)
SELECT total, eligible, total - eligible AS ineligible, n_b2b, n_payroll, abs(eligible / total - 0.5) <= 0.25 AS balanced FROM s""",
)
def golden_stats(spark, sf_dir):
    return ev.golden_stats(golden(spark, sf_dir)).select("total", "eligible", "ineligible", "n_b2b", "n_payroll", "balanced")


@query(
    "eval_warnings",
    f"""WITH {GOLD_SQL}, s AS (SELECT lang, count(*) AS total, count(*) FILTER (eligible) AS eligible FROM g GROUP BY lang)
SELECT lang, total < 30 AS too_small, total < 100 AS not_reportable, total >= 20 AND abs(eligible / total - 0.5) > 0.25 AS lopsided_warning FROM s""",
)
def eval_warnings(spark, sf_dir):
    """Small and lopsided sets, one set per language."""
    gold = golden(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return ev.golden_stats(gold, ["lang"]).select("lang", "too_small", "not_reportable", "lopsided_warning")


@query(
    "golden_reload",
    """SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 4 = 0 THEN quality <> 1 ELSE quality = 1 END AS eligible,
  CASE WHEN doc_id % 4 = 0 THEN 'second' ELSE 'first' END AS labelled_by FROM labels""",
)
def golden_reload(spark, sf_dir):
    """Labels appended as JSON lines, some again later; read back, the last line per id wins."""
    path = f"{scratch(spark)}/golden"
    labels = table(spark, sf_dir, "labels")

    def rows(who: str, flip: bool) -> DataFrame:
        eligible = (F.col("quality") == 1) if not flip else (F.col("quality") != 1)
        return labels.select(
            F.col("doc_id").cast("string").alias("id"),
            F.struct(eligible.alias("eligible"), F.lit("b2b").alias("employment_type")).alias("label"),
            F.lit(who).alias("labelled_by"),
        )

    sinks.append_state(rows("first", False).withColumn("labelled_at", F.lit("2024-01-01T00:00:00Z")), path)
    again = rows("second", True).where("id % 4 = 0").withColumn("labelled_at", F.lit("2024-01-02T00:00:00Z"))
    sinks.append_state(again, path)
    lines = spark.read.text(path)
    at = F.unix_micros(F.get_json_object("value", "$.labelled_at").cast("timestamp"))
    return ev.parse_golden(lines.withColumn("ord", at)).select("id", "label.eligible", "labelled_by")


@query(
    "label_queue",
    """SELECT doc_id FROM documents WHERE substr(sha1(CASE WHEN doc_id % 7 = 0 THEN 'Company ' || doc_id % 50 || '|Role in ' || lang
  ELSE 'https://docs.example.com/' || doc_id END), 1, 12) NOT IN (SELECT substr(sha1(CASE WHEN d.doc_id % 7 = 0 THEN 'Company ' || d.doc_id % 50 || '|Role in ' || lang
  ELSE 'https://docs.example.com/' || d.doc_id END), 1, 12) FROM documents d JOIN labels USING (doc_id))""",
)
def label_queue(spark, sf_dir):
    """Documents without a label, by stable id."""
    pool = doc_postings(spark, sf_dir).drop("id")
    done = pool.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    labelled = done.select(ev.golden_id(F.col("url"), F.col("company"), F.col("title")).alias("id"))
    return ev.label_queue(pool, labelled).select("doc_id")


@query(
    "label_preview",
    """SELECT doc_id, md5('Company ' || doc_id % 50 || ' — Role in ' || lang || chr(10) || source || ' · ' ||
  CASE WHEN doc_id % 3 = 0 THEN '(no location)' ELSE lang END || ' · (no date)' || chr(10) ||
  CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'https://docs.example.com/' || doc_id END || chr(10) || chr(10) ||
  CASE WHEN doc_id % 5 = 0 THEN '(no description published)' ELSE coalesce(nullif(array_to_string(
    list_filter(string_split(text, chr(10)), lambda x: x <> '')[1:12], chr(10)), ''), '(no description published)') END) AS preview_md5 FROM documents""",
)
def label_preview(spark, sf_dir):
    return doc_postings(spark, sf_dir).select("doc_id", F.md5(reports.label_preview()).alias("preview_md5"))


@query(
    "confidence_split",
    f"""WITH {SCORE_SQL} SELECT CASE WHEN confidence >= 0.6 THEN 'confident' ELSE 'review' END AS band, count(*) AS n FROM scores WHERE eligible GROUP BY band""",
)
def confidence_split(spark, sf_dir):
    scored = prefilter.eligible_only(scored_docs(spark, sf_dir))
    return scored.groupBy(prefilter.confidence_band(0.6).alias("band")).agg(F.count(F.lit(1)).alias("n"))
