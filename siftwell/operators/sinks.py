"""Files a run leaves behind, and how state files are read back."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siftwell.functions.dates import to_iso_date
from siftwell.operators.versions import Versions

# The columns of the CSV, in order.
CSV_COLUMNS = [
    "source", "company", "title", "location", "salary", "postedAt", "eligible", "employmentType", "confidence",
    "regionConstraint", "reason", "url",
]


def csv_rows(scored: DataFrame) -> DataFrame:
    """Scored postings flattened to the CSV columns, all text, empty where unknown."""
    c = F.col("classification")
    blank = F.lit("")
    values: dict[str, Column] = {
        "postedAt": to_iso_date(F.col("posted_at")),
        "eligible": c["eligible"].cast("string"),
        "employmentType": c["employment_type"],
        "confidence": c["confidence"].cast("string"),
        "regionConstraint": c["region_constraint"],
        "reason": c["reason"],
    }
    return scored.select(*[F.coalesce(values.get(n, F.col(n)), blank).alias(n) for n in CSV_COLUMNS])


CSV_OPTIONS = {"header": "true", "quoteAll": "true", "quote": '"', "escape": '"', "emptyValue": ""}


def write_csv(scored: DataFrame, path: str) -> None:
    """Every value quoted, quotes doubled. The header is quoted too."""
    csv_rows(scored).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{n} string" for n in CSV_COLUMNS)
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine="true", nullValue="\u0000").csv(path)


def write_snapshots(scored: DataFrame, root: str, day: date) -> None:
    """All scored postings as the latest snapshot, and the eligible ones under their day.

    Both go to folders of their own and are published together, by one rename; until then, and
    if the run dies, readers see the snapshots before. A second run of a day replaces its first.
    """
    versions = Versions(scored.sparkSession, root)
    number, content = versions.latest()
    mark = uuid.uuid4().hex
    latest, dated = f"latest/version={mark}", f"jobs/run_date={day.isoformat()}/version={mark}"
    # Postings repeat their texts, so that a packed file is a small part of a plain one.
    scored.write.json(f"{root}/{latest}", compression="gzip")
    scored.where(F.col("classification.eligible")).write.json(f"{root}/{dated}", compression="gzip")
    days = {**content.get("days", {}), day.isoformat(): dated}
    versions.publish(number + 1, {"latest": latest, "days": days})
    # Readers of the version before may still be at work; what lies behind it goes.
    live = {n for v in sorted(versions.numbers())[-2:] for n in _folders(versions.read(v))}
    for old in versions.forget(keep=2):
        for name in _folders(old) - live:
            versions.delete(name)


def _folders(content: dict) -> set[str]:
    return {content["latest"], *content["days"].values()} if content else set()


def read_latest(spark: SparkSession, root: str, schema: StructType | str) -> DataFrame:
    """The latest snapshot; empty before the first."""
    _, content = Versions(spark, root).latest()
    empty = spark.createDataFrame([], schema)
    return spark.read.schema(empty.schema).json(f"{root}/{content['latest']}") if content else empty


def read_days(spark: SparkSession, root: str, schema: StructType | str) -> DataFrame:
    """Eligible postings of all days, with ``run_date``."""
    _, content = Versions(spark, root).latest()
    dated = StructType(spark.createDataFrame([], schema).schema.fields).add("run_date", "date")
    if not content:
        return spark.createDataFrame([], dated)
    whole = StructType([*dated.fields]).add("version", "string")
    paths = [f"{root}/{name}" for name in content["days"].values()]
    return spark.read.schema(whole).option("basePath", f"{root}/jobs").json(paths).drop("version")


def write_lines(lines: DataFrame, path: str, *order: str) -> None:
    """Text lines in order, as one sorted text output."""
    lines.orderBy(*order).select(F.col("line").alias("value")).write.mode("overwrite").text(path)


class CorruptState(RuntimeError):
    """A state table that must not be lost cannot be read."""


def complete_line(value: str) -> Column:
    """Whether a line is one whole JSON object and nothing else."""
    whole = F.try_parse_json(F.concat(F.lit("["), F.col(value), F.lit("]"))).isNotNull()
    return whole & F.startswith(F.ltrim(value), F.lit("{"))


def load_state(spark: SparkSession, path: str, schema: StructType | str, on_corrupt: str = "raise") -> DataFrame:
    """State kept as JSON lines. A missing table is empty.

    ``on_corrupt="empty"`` reads a damaged table as empty (losing it costs little);
    ``on_corrupt="raise"`` refuses (losing it would repeat actions).
    """
    if on_corrupt not in ("empty", "raise"):
        raise ValueError(f"on_corrupt is empty or raise, not {on_corrupt}")
    empty = spark.createDataFrame([], schema)
    try:
        text = spark.read.text(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return empty
        raise
    lines = text.where(F.trim("value") != "")
    if lines.where(~complete_line("value")).isEmpty():
        return lines.select(F.from_json("value", empty.schema).alias("row")).select("row.*")
    if on_corrupt == "raise":
        raise CorruptState(f"{path} is corrupt; fix or restore it before going on")
    return empty


def open_state(spark: SparkSession, root: str, schema: StructType | str) -> tuple[DataFrame, str]:
    """State that costs little to lose, and the folder to append to.

    The state lives in numbered versions below ``root``; the newest counts. A damaged version is
    left as it is and read as empty, and what comes next goes into a fresh one, so one bad line
    does not spoil all later runs.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    newest = max([int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()], default=1)
    try:
        return load_state(spark, f"{root}/v={newest}", schema), f"{root}/v={newest}"
    except CorruptState:
        return spark.createDataFrame([], schema), f"{root}/v={newest + 1}"


def append_state(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)
