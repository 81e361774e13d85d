"""Numbered versions of a folder, each published by one rename.

A version is a small JSON file below ``_versions`` that names the data folders it stands for. It is
written under another name first and renamed to the next number, which must not exist yet; so a
reader sees the old version or the new one, whatever happens to the writer, and of two writers that
began with the same version one is refused. Data folders are written before and never changed.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


class ConcurrentChange(RuntimeError):
    """Someone else has published the next version in the meantime."""


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._path(f"{self.root}/{name}")

    def names(self, folder: str) -> list[str]:
        """What lies in a folder below the root; nothing if there is none."""
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self._files.listStatus(at)) if self._files.exists(at) else []

    def exists(self, name: str) -> bool:
        return self._files.exists(self.path(name))

    def size(self, name: str) -> int:
        """Bytes below a folder."""
        return self._files.getContentSummary(self.path(name)).getLength() if self.exists(name) else 0

    def delete(self, name: str) -> None:
        self._files.delete(self.path(name), True)

    def numbers(self) -> list[int]:
        return [int(n) for n in self.names("_versions") if n.isdigit()]

    def read(self, number: int) -> dict[str, Any]:
        stream = self._files.open(self.path(f"_versions/{number:09d}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict[str, Any]]:
        """Number and content of the newest version; 0 and nothing before the first."""
        numbers = self.numbers()
        return (max(numbers), self.read(max(numbers))) if numbers else (0, {})

    def publish(self, number: int, content: dict[str, Any]) -> None:
        """Make ``content`` version ``number``, which must be the next one."""
        draft, final = self.path(f"_versions/_draft-{uuid.uuid4().hex}"), self.path(f"_versions/{number:09d}")
        self._files.mkdirs(final.getParent())
        out = self._files.create(draft, False)
        try:
            out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            out.close()
        if self._files.exists(final) or not self._files.rename(draft, final):
            self._files.delete(draft, False)
            raise ConcurrentChange(f"version {number} of {self.root} is there already")

    def forget(self, keep: int) -> list[dict[str, Any]]:
        """Remove all but the newest ``keep`` version files; returns what they named."""
        old = sorted(self.numbers())[:-keep]
        contents = [self.read(n) for n in old]
        for n in old:
            self.delete(f"_versions/{n:09d}")
        return contents
