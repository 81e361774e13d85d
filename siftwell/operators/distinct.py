"""First or latest row per key.

``row_number() <= n`` filters are planned with a group limit before the shuffle, so every
map task sends at most n rows per key and a hot key stays small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1, nth: str | None = None) -> DataFrame:
    """First ``n`` rows per key; ``nth`` names a column for the rank, from 1."""
    name = nth or "_nth"
    w = Window.partitionBy(*keys).orderBy(*order)
    top = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return top if nth else top.drop(name)


def first_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return top_per_key(df, keys, [F.col(order).asc()])


def latest_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return top_per_key(df, keys, [F.col(order).desc()])
