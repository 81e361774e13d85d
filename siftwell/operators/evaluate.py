"""Scoring a scorer against labelled postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.money import estimate_cost, per_thousand, ratio, to_fixed
from siftwell.functions.text import format_pct, golden_id, trim_space
from siftwell.operators.distinct import latest_per_key
from siftwell.schema import EMPLOYMENT_TYPES, Pricing
from siftwell.sources.payloads import kind, one_value

# Set sizes below which scores are not reportable, the share tolerance,
# and how many disagreements a report lists.
SMALL_SET, REPORTABLE_SET, WARN_FROM = 30, 100, 20
BALANCE_TOLERANCE = 0.25
LISTED_DISAGREEMENTS = 15
NO_PREDICTION = "no prediction"

GOLDEN = (
    "id string, job struct<source string, company string, title string, location string, url string,"
    " posted_at string, description string>,"
    " label struct<eligible boolean, employment_type string, note string>, labelled_at string, labelled_by string"
)


def parse_golden(lines: DataFrame, order: str = "ord") -> DataFrame:
    """Golden records from JSON lines (``value``): blank lines skipped, a bad line is an error,
    and the last line per id wins."""
    text = trim_space(F.col("value"))
    bad = F.raise_error(F.concat(F.lit("line "), F.col(order).cast("string"), F.lit(" is not valid JSON")))
    # A line holds one object: neither a second one nor anything else may follow it.
    one = F.coalesce(F.startswith(kind(one_value(text)), F.lit("OBJECT")), F.lit(False))
    valid = F.when(one, F.lit(True)).otherwise(bad)
    parsed = lines.where(text != "").where(valid).withColumn("_json", F.from_json(text, GOLDEN))
    return latest_per_key(parsed.select(order, "_json.*"), ["id"], order)


def golden_stats(golden: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row, or one per ``by``: sizes, a count per employment type, balance and small-set warnings."""
    eligible = F.col("label.eligible")
    counts = [
        F.count_if(F.col("label.employment_type") == t).alias(f"n_{t}") for t in EMPLOYMENT_TYPES
    ]
    base = golden.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("total"), F.count_if(eligible).alias("eligible"), *counts)
    share = F.try_divide(F.col("eligible").cast("double"), F.col("total").cast("double"))
    balanced = F.coalesce(F.abs(share - 0.5) <= BALANCE_TOLERANCE, F.lit(False))
    return (
        base.withColumn("ineligible", F.col("total") - F.col("eligible"))
        .withColumn("balanced", balanced)
        .withColumn("too_small", F.col("total") < SMALL_SET)
        .withColumn("not_reportable", F.col("total") < REPORTABLE_SET)
        .withColumn("lopsided_warning", (F.col("total") >= WARN_FROM) & ~balanced)
    )


def types_in(golden: DataFrame) -> DataFrame:
    return golden.groupBy(F.col("label.employment_type").alias("employment_type")).agg(F.count(F.lit(1)).alias("n"))


def label_queue(pool: DataFrame, golden: DataFrame) -> DataFrame:
    """Postings of the pool that have no label yet."""
    keyed = pool.withColumn("id", golden_id(F.col("url"), F.col("company"), F.col("title")))
    return keyed.join(golden.select("id").distinct(), "id", "left_anti")


def join_predictions(golden: DataFrame, predictions: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Golden records with their prediction; a missing one counts as not eligible.

    Golden records and predictions hold each id (and version) once, so no key is hot.
    """
    keys = keys or ["id"]
    joined = golden.join(predictions.select(*keys, F.col("classification").alias("predicted")), keys, "left")
    return joined.withColumn("p", F.coalesce(F.col("predicted.eligible"), F.lit(False))).withColumn(
        "expected", F.col("label.eligible")
    )


def _cells() -> list[Column]:
    p, e = F.col("p"), F.col("expected")
    return [
        F.count_if(e & p).alias("true_positives"),
        F.count_if(~e & p).alias("false_positives"),
        F.count_if(~e & ~p).alias("true_negatives"),
        F.count_if(e & ~p).alias("false_negatives"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("predicted.employment_type") == F.col("label.employment_type")).alias("type_matches"),
    ]


def confusion(joined: DataFrame, by: list[str] | None = None) -> DataFrame:
    return joined.groupBy(*(by or [])).agg(*_cells()).drop("total", "type_matches")


def metrics(joined: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Confusion cells with precision, recall, F1, accuracy and employment-type accuracy."""
    m = joined.groupBy(*(by or [])).agg(*_cells())
    tp, fp, fn, tn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives", "true_negatives"))
    m = m.withColumn("precision", ratio(tp, tp + fp)).withColumn("recall", ratio(tp, tp + fn))
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return (
        m.withColumn("f1", f1)
        .withColumn("accuracy", ratio(tp + tn, F.col("total")))
        .withColumn("employment_type_accuracy", ratio(F.col("type_matches"), F.col("total")))
        .drop("type_matches")
    )


def disagreements(joined: DataFrame) -> DataFrame:
    """Every case the scorer got wrong."""
    return joined.where(F.col("p") != F.col("expected")).select(
        "id",
        F.col("job.title").alias("title"),
        F.col("job.company").alias("company"),
        F.col("job.url").alias("url"),
        "expected",
        F.col("p").alias("predicted"),
        F.coalesce(F.col("predicted.confidence"), F.lit(0.0)).alias("confidence"),
        F.coalesce(F.col("predicted.reason"), F.lit(NO_PREDICTION)).alias("reason"),
        F.col("label.note").alias("note"),
    )


def listed_disagreements(wrong: DataFrame, order: str = "id") -> DataFrame:
    return wrong.orderBy(order).limit(LISTED_DISAGREEMENTS)


def with_cost(stats: DataFrame, pricing: Pricing = Pricing()) -> DataFrame:
    """Cost columns from ``input_tokens``, ``output_tokens`` and ``calls``."""
    cost = estimate_cost(
        F.col("input_tokens"), F.col("output_tokens"), pricing.input_per_million, pricing.output_per_million
    )
    return stats.withColumn("cost_usd", cost).withColumn("cost_per_1k_usd", per_thousand(F.col("cost_usd"), F.col("calls")))


def metric_text(result: DataFrame) -> DataFrame:
    """A text block and a markdown row per scored version."""
    pct = {c: format_pct(F.col(c)) for c in ("precision", "recall", "f1", "accuracy", "employment_type_accuracy")}
    text = F.concat_ws(
        "\n",
        F.format_string("prompt %s on %s/%s", "version", "provider", "model"),
        F.format_string("  n=%d  precision=%s  recall=%s  F1=%s", "total", pct["precision"], pct["recall"], pct["f1"]),
        F.format_string("  accuracy=%s  employment-type accuracy=%s", pct["accuracy"], pct["employment_type_accuracy"]),
        F.format_string(
            "  TP=%d FP=%d TN=%d FN=%d", "true_positives", "false_positives", "true_negatives", "false_negatives"
        ),
        F.format_string(
            "  %d call failures, $%s spent, $%s per 1000 postings",
            "failures", to_fixed(F.col("cost_usd"), 4), to_fixed(F.col("cost_per_1k_usd"), 2),
        ),
    )
    row = F.format_string(
        "| %s | %s | %d | %s | %s | %s | $%s |",
        "version", "model", "total", pct["precision"], pct["recall"], pct["f1"], to_fixed(F.col("cost_per_1k_usd"), 2),
    )
    return result.withColumn("text", text).withColumn("markdown", row)


# Heading of the markdown table.
MARKDOWN_HEADER = (
    "| Prompt | Model | n | Precision | Recall | F1 | Cost / 1k |\n| --- | --- | --- | --- | --- | --- | --- |"
)
