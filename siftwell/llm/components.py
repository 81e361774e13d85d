"""Connected components of an edge table, by alternating star contractions.

Large star: every node hands its larger neighbours to the smallest node it sees. Small star: every
node hands its smaller neighbours, and itself, to the smallest of them. After about log(n) rounds
each node points at the smallest node of its component. A round is two group minima (combined
map-side) and two joins; a node with very many neighbours is a skewed join key, which adaptive
execution splits. Edges between rounds are kept in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.runtime import cut_lineage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    moved = both.where(F.col("b") > F.col("a")).join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("m"))
    moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) for every node of an edge except the smallest of its component.

    ``edges`` has BIGINT columns ``a`` and ``b``. Nulls and loops are ignored.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = cut_lineage(edges.distinct())
    state = _state(edges)
    while state[0]:
        edges = cut_lineage(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
