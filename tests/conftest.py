import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from siftwell.runtime import local_session  # noqa: E402


# Column expressions need a running session, also those that test modules build on import.
SESSION = local_session("tests", cores="8", partitions=4)
# A few rows per test: compiling every stage would take longer than running it.
SESSION.conf.set("spark.sql.codegen.wholeStage", "false")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def one(spark):
    """Value of an expression over one row of text ``x``."""

    def run(expression, x=None):
        return spark.createDataFrame([(x,)], "x string").select(expression.alias("v")).first()["v"]

    return run
