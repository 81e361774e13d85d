"""Scoring prompt versions against the golden set."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.operators import evaluate, scoring
from siftwell.schema import Pricing


@dataclass(frozen=True)
class Evaluation:
    """Metrics with cost per version, and every wrong case."""

    results: DataFrame
    disagreements: DataFrame


def run_evaluation(
    golden: DataFrame,
    prompts: list[scoring.Prompt],
    make_scorer: scoring.MakeScorer,
    root: str,
    pricing: Pricing = Pricing(),
    **options,
) -> Evaluation:
    """Score each prompt once (a rerun asks only for what is missing) and compare.

    Prompts of one version name and an empty golden set are refused before any model call.
    """
    versions = [p.version for p in prompts]
    if len(set(versions)) < len(versions):
        raise ValueError("every prompt needs a version name of its own")
    if golden.isEmpty():
        raise ValueError("the golden set is empty; label some postings first")
    jobs = golden.select("id", "job.*")
    scores = [scoring.score_once(jobs, make_scorer, p, f"{root}/scores", **options) for p in prompts]
    predictions = reduce(DataFrame.unionByName, scores)
    tagged = golden.withColumn("version", F.explode(F.array(*[F.lit(v) for v in versions])))
    joined = evaluate.join_predictions(tagged, predictions, ["version", "id"])
    metrics = evaluate.metrics(joined, ["version"])
    cost = scoring.score_stats(predictions, ["version"], pricing)
    wrong = evaluate.disagreements(joined.withColumn("id", F.concat_ws(":", "version", "id")))
    return Evaluation(metrics.join(cost, "version"), wrong)
