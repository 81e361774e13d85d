"""Incremental runs: process what has landed since the last run, then stop."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from siftwell.operators.statelog import history_log


def run_available(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Feed every micro-batch that is available to ``handle`` and wait for the end."""
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def ingest(
    spark: SparkSession,
    landing: str,
    schema: StructType | str,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    fmt: str = "json",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Landed files to a silver table, file by file exactly once.

    Each batch overwrites its own folder, so a batch that is repeated after a failure replaces
    what its first try left.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(landing)

    def handle(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return run_available(stream, handle, checkpoint)


# The state store that keeps keys on disk and uploads what a batch changed.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def state_partitions(spark: SparkSession) -> int:
    """Partitions of a stream's state: one per core, and no more than the session's shuffles have.

    Every batch opens and commits each of them, however few rows it brings, so more than can run
    side by side only add to the time of a batch. A started checkpoint keeps the number it has.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def stream_first_seen(stream: DataFrame, target: str, checkpoint: str, moment: str = "ts") -> StreamingQuery:
    """First-seen dates of a stream's urls, kept at ``target``; read them with :func:`first_seen_table`.

    The earliest moment per url is keyed state in the state store: a batch looks up the urls it
    holds and hands on their dates, and reads nothing else, however many urls are known. Nothing
    expires, so no watermark is needed and a late file may date a url earlier. Each batch's dates
    are a change of a :class:`~siftwell.operators.statelog.StateLog`, named after the checkpoint
    folder and the batch: a repeated batch replaces its own, and a run with a new checkpoint folder
    adds to what earlier ones left. Changes are merged when they are many.
    """
    spark = stream.sparkSession
    log = history_log(spark, target)
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    named = stream.where(F.coalesce(F.col("url"), F.lit("")) != "")
    first = named.groupBy("url").agg(F.min(moment).alias("first"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        log.append(batch.select("url", F.to_date("first").alias("first_seen")), f"{run}-{batch_id}")
        log.compact_if_due()

    # A query keeps the settings it was started under; merges of the table use the caller's.
    settings = {**STATE_STORE, "spark.sql.shuffle.partitions": str(state_partitions(spark))}
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        writer = first.writeStream.foreachBatch(handle).outputMode("update").option("checkpointLocation", checkpoint)
        query = writer.trigger(availableNow=True).start()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    query.awaitTermination()
    return query


def first_seen_table(spark: SparkSession, target: str) -> DataFrame:
    """History as (url, first_seen), from all batches."""
    return history_log(spark, target).read()
