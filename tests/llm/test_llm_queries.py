"""The package's queries on the smallest tables, next to SQL where there is some."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent / "tools"))

import __spark_entry__ as entry
from check import TABLES, rows_of
from siftwell.llm import queries, secrets

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="benchmark tables are not here")


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_every_row_has_a_result(spark, name):
    df = queries.QUERIES[name](spark, SF)
    got = df.select(df.columns[0]).distinct().count()
    if name.startswith("op5"):
        assert got > 0
    else:
        table = {"op1": "pages", "op13": "embeddings"}.get(name.split("_")[0], "documents")
        assert got == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if i < 4:
            assert after.columns == columns
            assert 0 < after.count() <= seen
            seen = after.count()
        if name == "secrets":
            assert not [r for r in after.select("text").collect() if 'token = "' in r[0] and secrets.MASK not in r[0]]
            assert {r[0] for r in after.select("doc_id").collect()} == {r[0] for r in docs.select("doc_id").collect()}
        docs_before, docs = docs, after
    ids = {r[0] for r in docs_before.select("doc_id").collect()}
    assert {r[0] for r in docs.select("doc_id").collect()} == ids
    assert corpus_pipeline.run(spark, SF).count() == docs.count()
