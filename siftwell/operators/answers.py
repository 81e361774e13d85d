"""Checking prepared answers against the questions of a form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.text import pick_option, trim_space


def accepted_values(answer: Column, options: Column, max_length: Column) -> Column:
    """Answers that may be given: trimmed, matched to an offered option, cut to length."""
    none = F.array().cast("array<string>")
    values = F.filter(F.transform(F.coalesce(answer, none), trim_space), lambda v: v != "")
    matched = F.filter(F.transform(values, lambda v: pick_option(options, v)), lambda v: F.coalesce(v, F.lit("")) != "")
    chosen = F.when(F.size(F.coalesce(options, none)) > 0, matched).otherwise(values)
    limited = F.coalesce(max_length, F.lit(0)) > 0
    return F.when(limited, F.transform(chosen, lambda v: F.substring(v, F.lit(1), max_length))).otherwise(chosen)


def validate_answers(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """One row per question: ``accepted`` answers, and ``unanswered`` (the label to ask a person
    about) for a required question without one.

    ``questions``: form_id, id, label, name, required, options, max_length.
    ``answers``: form_id, id, answer (a list). The pair of ids is unique on both sides.
    """
    joined = questions.join(answers.select("form_id", "id", "answer"), ["form_id", "id"], "left")
    checked = joined.withColumn("accepted", accepted_values(F.col("answer"), F.col("options"), F.col("max_length")))
    shown = F.when(F.coalesce(F.col("label"), F.lit("")) != "", F.col("label")).otherwise(F.col("name"))
    missing = (F.size("accepted") == 0) & F.col("required")
    return checked.withColumn("unanswered", F.when(missing, shown)).drop("answer")
