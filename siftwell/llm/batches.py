"""Smaller pieces of Arrow batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa

# Rows whose words are held as Python objects at a time.
ROWS = 500


def pieces(batch: pa.RecordBatch, rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def hand_back() -> None:
    """Give what a task has freed back to the system; Python workers live on for later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
