"""Named queries over the benchmark tables, each with the SQL that must agree with it."""

from siftwell.catalog.registry import ORACLES, QUERIES
from siftwell.catalog import cleaning, judging, landed, outputs, state, texts, web  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
