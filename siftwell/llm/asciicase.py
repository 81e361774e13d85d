"""Lower case for the letters A to Z only."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
