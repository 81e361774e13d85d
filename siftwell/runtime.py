"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

SQL_SETTINGS = {
    # Dates are compared and printed in UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Work on text is CPU-bound: narrow rows that come out of a shuffle still deserve many tasks.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    # Beyond 8000 bytes the JVM does not compile a method; split expressions run faster then.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Python workers and their buffers hold one batch at a time; rows with long texts make batches short.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    # Feeds repeat keys now and then; the last one wins, as in any JSON reader.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the operators rely on to a running session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    # The few functions that run in Python workers travel with the job, so executors need no
    # installed copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules["siftwell"])
    return spark


# Adaptive execution merges small partitions but never splits a large one of a plain shuffle, so the
# number a shuffle starts with bounds how much one task holds.
FINEST = 256
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def finer_shuffles(spark: SparkSession) -> SparkSession:
    """Let shuffles start with many partitions, so that a task's share does not grow with the data.

    They are merged to Spark's advisory size before they are read. A session that starts with more,
    or names a number itself, keeps it.
    """
    if spark.conf.get(INITIAL_PARTITIONS, None) is None and int(spark.conf.get("spark.sql.shuffle.partitions")) < FINEST:
        spark.conf.set(INITIAL_PARTITIONS, str(FINEST))
    return spark


def local_session(name: str = "siftwell", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point reliable checkpoints at the folder the cluster names.

    ``spark.checkpoint.dir`` wins when it is set. A temporary folder is made only
    for a local master; a cluster without the setting is refused, because a folder
    on one machine is lost with that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="siftwell-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and restart its lineage there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession) -> str:
    """A new folder for one run's intermediate tables, inside the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"


def cut_packed(df: DataFrame) -> DataFrame:
    """:func:`cut_lineage` for rows with texts: kept as compressed columns, a fraction of a checkpoint's size."""
    at = f"{scratch(df.sparkSession)}/rows"
    df.write.option("compression", "zstd").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
