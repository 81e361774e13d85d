import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))


@pytest.fixture(scope="session")
def run(spark):
    """Rows of a frame as plain tuples."""

    def collect(df):
        return [tuple(r) for r in df.collect()]

    return collect


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with the hard cases: null, empty, white space, ties, repeats, clashing columns."""

    def make(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        if not extra:
            return df
        from pyspark.sql import functions as F

        clash = ["words", "host", "doc", "score", "margin", "gram", "n", "component_id", "part", "body", "findings"]
        return df.withColumns({c: F.lit("x") for c in clash})

    return make
