"""The landing table: fetched documents as they came, one row each, partitioned by source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftwell.schema import BRONZE


def write_landed(bronze: DataFrame, path: str, mode: str = "append") -> None:
    """``source, company, url, payload, seq``. A reader of one source then reads its folder only."""
    bronze.select("source", "company", "url", "payload", "seq").write.mode(mode).partitionBy("source").parquet(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE).parquet(path)
