"""Decision trees trained by Spark, as plain nested tuples or as Column expressions.

A tree is either a number (the prediction) or (feature, threshold, left, right): left holds for
values up to the threshold.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")
_LEAF = re.compile(r"Predict: (\S+)")


def _read(lines: list[str], at: int) -> tuple:
    """Tree that begins on line ``at`` of a model's description, and the line after it."""
    leaf = _LEAF.search(lines[at])
    if leaf:
        return float(leaf[1]), at + 1
    split = _SPLIT.search(lines[at])
    left, at = _read(lines, at + 1)
    right, at = _read(lines, at + 1)
    return (int(split[1]), float(split[2]), left, right), at


def trees_of(description: str) -> list:
    """Trees in ``toDebugString`` of a tree or a forest."""
    lines = [x.strip() for x in description.splitlines()]
    found = []
    at = 0
    while at < len(lines):
        if _SPLIT.search(lines[at]) or _LEAF.search(lines[at]):
            tree, at = _read(lines, at)
            found.append(tree)
        else:
            at += 1
    return found


def train_trees(examples: DataFrame, features: str, label: str, trees: int, depth: int, seed: int = 7) -> list:
    """One tree, or a random forest, on a small table: ``features`` array<double>, ``label`` 0 or 1."""
    rows = examples.select(
        array_to_vector(F.col(features)).alias("features"), F.col(label).cast("double").alias("label")
    ).coalesce(1)
    if trees == 1:
        learner = DecisionTreeClassifier(maxDepth=depth, seed=seed)
    else:
        learner = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt")
    return trees_of(learner.fit(rows).toDebugString)


def decide(tree, values) -> float:
    while isinstance(tree, tuple):
        feature, threshold, left, right = tree
        tree = left if values[feature] <= threshold else right
    return tree


def decision(tree, values: Column) -> Column:
    """A tree over an array column."""
    if not isinstance(tree, tuple):
        return F.lit(tree)
    feature, threshold, left, right = tree
    return F.when(F.get(values, F.lit(feature)) <= F.lit(threshold), decision(left, values)).otherwise(
        decision(right, values)
    )


def votes(forest: list, values: Column) -> Column:
    """Share of trees that predict 1."""
    total = decision(forest[0], values)
    for tree in forest[1:]:
        total = total + decision(tree, values)
    return total / F.lit(float(len(forest)))
