"""Computing a value once inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once.

    The optimizer may copy a column's expression into every place that names the column (it does
    so when it moves a filter); a bound value is copied whole instead of once per use.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
