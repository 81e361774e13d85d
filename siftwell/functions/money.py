"""Money and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def estimate_cost(input_tokens: Column, output_tokens: Column, per_million_in: float, per_million_out: float) -> Column:
    return input_tokens / F.lit(1e6) * F.lit(per_million_in) + output_tokens / F.lit(1e6) * F.lit(per_million_out)


def per_thousand(cost: Column, rows: Column) -> Column:
    return F.coalesce(F.try_divide(cost, rows.cast("double")) * 1000.0, F.lit(0.0))


def to_fixed(c: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", c)


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient that is 0 where the divisor is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))
