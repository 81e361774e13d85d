"""Turning arrays into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, values: Column, pos: str, item: str) -> DataFrame:
    """One row per element, with its position from 0; rows without elements give none.

    For a plain explode the optimizer adds a filter on the array's size, which evaluates the
    array a second time. The outer form is left alone, so an expensive array is built once.
    """
    return df.select("*", F.posexplode_outer(values).alias(pos, item)).where(F.col(pos).isNotNull())
