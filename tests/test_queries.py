"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry
from check import TABLES, rows_of
from siftwell import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_a_query_starts_its_shuffles_finer_than_a_small_session(spark):
    """Adaptive execution cannot split the partitions that the session's few would make too large."""
    from siftwell.runtime import FINEST, INITIAL_PARTITIONS

    before = spark.conf.get(INITIAL_PARTITIONS, None)
    spark.conf.unset(INITIAL_PARTITIONS)
    try:
        df = entry.queries()["observed_counts"](spark, SF)
        assert spark.conf.get(INITIAL_PARTITIONS) == str(FINEST)
        plan = df.groupBy(*df.columns[:1]).count()._jdf.queryExecution().executedPlan().toString()
        assert f", {FINEST})" in plan
        spark.conf.set(INITIAL_PARTITIONS, "7")
        entry.queries()["observed_counts"](spark, SF)
        assert spark.conf.get(INITIAL_PARTITIONS) == "7"
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)
