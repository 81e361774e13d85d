"""State across runs as a merged base and the changes since.

Rows are appended as small JSON folders ("deltas"), which anyone can read and no later run touches.
Now and then they are merged with the base into a new one: a row per key, range-partitioned and
sorted by key, as Parquet. So reading costs what is alive plus the changes since the last merge,
however often a key was written, and a look-up by key prunes the base by its minima and maxima.

The new base and the list of deltas it holds are published by one rename (:mod:`.versions`). A merge
that dies in the middle leaves the old base and all deltas as they are; one that dies after it has
published leaves deltas that are listed as merged, and those are not read again. A delta counts
once Spark has committed it (its ``_SUCCESS`` mark).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from siftwell.operators.distinct import latest_per_key
from siftwell.operators.history import first_sightings
from siftwell.operators.sinks import CorruptState, complete_line
from siftwell.operators.versions import Versions
from siftwell.schema import HISTORY, LEDGER

# A merge is due after so many deltas, or when they hold this part of the base's bytes.
MOST_DELTAS = 32
MOST_SHARE = 0.25
LEAST_BYTES = 8 << 20


class StateLog:
    """Keyed state below ``root``.

    ``merge`` makes one row per key of rows in any order and number; merging what was merged before
    changes nothing. ``on_corrupt`` says what a damaged delta means: ``raise`` refuses to go on,
    ``skip`` leaves it where it is and reads the rest.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType | str,
        keys: list[str],
        merge: Callable[[DataFrame], DataFrame],
        on_corrupt: str = "raise",
    ):
        if on_corrupt not in ("raise", "skip"):
            raise ValueError(f"on_corrupt is raise or skip, not {on_corrupt}")
        self.spark, self.root, self.keys, self.merge, self.on_corrupt = spark, root.rstrip("/"), keys, merge, on_corrupt
        self.schema = spark.createDataFrame([], schema).schema
        self.versions = Versions(spark, self.root)

    def append(self, rows: DataFrame, name: str | None = None) -> None:
        """Add rows. A ``name`` makes the change repeatable: the same name replaces what it wrote before."""
        name = name or f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        rows.select(*self.schema.names).write.mode("overwrite").json(f"{self.root}/delta/{name}")

    def deltas(self) -> list[str]:
        """Committed changes that no base holds yet."""
        _, content = self.versions.latest()
        merged = set(content.get("merged", []))
        names = [n for n in self.versions.names("delta") if n not in merged]
        return [n for n in names if self.versions.exists(f"delta/{n}/_SUCCESS")]

    def read(self) -> DataFrame:
        """One row per key."""
        return self._state(self._sound(self.deltas()))

    def due(self) -> bool:
        """Whether merging is worth its cost."""
        deltas = self.deltas()
        _, content = self.versions.latest()
        base = self.versions.size(content["base"]) if content.get("base") else 0
        added = sum(self.versions.size(f"delta/{n}") for n in deltas)
        return len(deltas) > MOST_DELTAS or added > max(LEAST_BYTES, MOST_SHARE * base)

    def compact(self) -> None:
        """Merge all changes into a new base and publish it."""
        number, content = self.versions.latest()
        deltas = self._sound(self.deltas())
        if not deltas:
            return
        base = f"base/{uuid.uuid4().hex}"
        rows = self._state(deltas).repartitionByRange(*self.keys).sortWithinPartitions(*self.keys)
        rows.write.parquet(f"{self.root}/{base}")
        # What was merged earlier and could not be removed then stays listed.
        there = set(self.versions.names("delta"))
        merged = [n for n in content.get("merged", []) if n in there] + deltas
        self.versions.publish(number + 1, {"base": base, "merged": merged})
        self._clean(merged)

    def compact_if_due(self) -> None:
        if self.due():
            self.compact()

    def _clean(self, merged: list[str]) -> None:
        """Remove merged deltas, and bases that neither the newest version nor the one before names."""
        for name in merged:
            self.versions.delete(f"delta/{name}")
        self.versions.forget(keep=2)
        live = {self.versions.read(n).get("base") for n in self.versions.numbers()}
        for name in self.versions.names("base"):
            if f"base/{name}" not in live and self.versions.exists(f"base/{name}/_SUCCESS"):
                self.versions.delete(f"base/{name}")

    def _lines(self, deltas: list[str]) -> DataFrame:
        text = self.spark.read.text([f"{self.root}/delta/{n}" for n in deltas])
        name = F.regexp_extract(F.col("_metadata.file_path"), r"/delta/([^/]+)/[^/]*\z", 1)
        return text.select("value", name.alias("name")).where(F.trim("value") != "")

    def _sound(self, deltas: list[str]) -> list[str]:
        """Deltas without a damaged line."""
        if not deltas:
            return []
        bad = {r["name"] for r in self._lines(deltas).where(~complete_line("value")).select("name").distinct().collect()}
        if bad and self.on_corrupt == "raise":
            raise CorruptState(f"{self.root}/delta/{min(bad)} is corrupt; fix or restore it before going on")
        return [n for n in deltas if n not in bad]

    def _state(self, deltas: list[str]) -> DataFrame:
        _, content = self.versions.latest()
        parts = [self.spark.createDataFrame([], self.schema)]
        if content.get("base"):
            parts.append(self.spark.read.schema(self.schema).parquet(f"{self.root}/{content['base']}"))
        if deltas:
            parts.append(self.spark.read.schema(self.schema).json([f"{self.root}/delta/{n}" for n in deltas]))
        return self.merge(reduce(DataFrame.unionByName, parts)).select(*self.schema.names)


def history_log(spark: SparkSession, root: str) -> StateLog:
    """First-seen dates. Losing some costs little, so a damaged change is passed over."""
    return StateLog(spark, root, HISTORY, ["url"], first_sightings, on_corrupt="skip")


def ledger_log(spark: SparkSession, root: str) -> StateLog:
    """Application records, the last write (``ord``) per url. Losing one would repeat an application."""
    # A copy of the list: adding to a shared one would change the schema for everyone.
    schema = StructType([*LEDGER.fields]).add("ord", LongType())
    return StateLog(spark, root, schema, ["url"], lambda rows: latest_per_key(rows, ["url"], "ord"))
