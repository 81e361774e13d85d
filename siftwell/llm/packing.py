"""Packing documents into token windows by the sum-of-squares rule.

Documents become token ids, closed by ``end_id``. Whole windows are cut off the front of long
documents; what is left is placed online: of all fill levels that have room (and a new window), it
goes to the one after which the sum over levels of the squared number of partly filled windows is
smallest, the fuller level on a tie. The counts per level are one array, so a choice costs one pass
over it.

Every task packs the documents of its partition and keeps only partly filled windows, at most
``MAX_OPEN``. When that many are open, and at the end, they are poured together: pieces of the
emptiest windows are cut to fill the fullest. One window stays partly filled; it is cut into
windows whose lengths are powers of two, which need no padding. So padding is zero, whatever the
number of partitions.

Cases: a null text counts as empty and gives one piece with ``end_id`` alone. Ids may repeat or be
null; every row is packed by itself. Other columns are ignored. A long document is held by one task
as four bytes a token.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.batches import hand_back

WINDOW = 2048
END_ID = 1
MAX_OPEN = 4096
# Windows get ids partition * SEQUENCES + n.
SEQUENCES = 1 << 33
ROWS_OUT = 4096


def byte_letters() -> dict[str, int]:
    """Letters of a byte-level vocabulary: printable bytes stand for themselves, the rest follow from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def text_encoder(vocabulary: str, pattern: str) -> Callable[[str], bytes]:
    """Text -> ids as little-endian unsigned 32-bit numbers, for a byte-level BPE vocabulary file."""
    import tiktoken

    with open(vocabulary, encoding="utf-8") as f:
        model = json.load(f)
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
    encoding = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> bytes:
        # Whole texts at once: words of web text are too varied to be worth keeping.
        return encoding.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()

    return encode


class _Piece:
    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, n: int) -> tuple[_Piece, _Piece]:
        return (
            _Piece(self.doc, self.start, self.ids[:n], self.total),
            _Piece(self.doc, self.start + n, self.ids[n:], self.total),
        )


class SumOfSquares:
    """Windows of one task. ``emit`` is called with the pieces of each finished window."""

    def __init__(self, window: int, emit: Callable[[list[_Piece]], None], max_open: int = MAX_OPEN):
        self.window, self.emit, self.max_open = window, emit, max_open
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list[list[_Piece]]] = [[] for _ in range(window)]
        self.n_open = 0

    def level_for(self, size: int) -> int:
        """Fill level to place ``size`` tokens into; 0 is a new window."""
        room = self.window - size
        before = self.counts[1 : room + 1]
        after = self.counts[1 + size : self.window + 1]
        # Change of the sum of squares; a window that becomes full leaves the sum.
        change = 2 * (after - before) + 2
        best, level = 2 * int(self.counts[size]) + 1 if size < self.window else 0, 0
        if room:
            change[room - 1] = 1 - 2 * before[room - 1]
            change[before == 0] = np.iinfo(np.int64).max
            at = room - 1 - int(change[::-1].argmin())
            if change[at] <= best:
                level = at + 1
        return level

    def add(self, doc, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.window:
            self.emit([_Piece(doc, start, ids[start : start + self.window], total)])
            start += self.window
        if start == total:
            return
        piece = _Piece(doc, start, ids[start:].copy(), total)
        size = len(piece.ids)
        level = self.level_for(size)
        pieces = []
        if level:
            pieces = self.open[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        pieces.append(piece)
        if level + size == self.window:
            self.emit(pieces)
            return
        self.open[level + size].append(pieces)
        self.counts[level + size] += 1
        self.n_open += 1
        if self.n_open >= self.max_open:
            self.pour()

    def pour(self) -> None:
        """Fill the fullest windows with pieces of the emptiest; at most one stays open."""
        windows = [w for level in reversed(self.open) for w in level]
        self.counts[:] = 0
        self.open = [[] for _ in range(self.window)]
        self.n_open = 0
        pool: list[_Piece] = []
        first, last = 0, len(windows) - 1
        while first <= last:
            pieces = windows[first]
            first += 1
            level = sum(len(p.ids) for p in pieces)
            while level < self.window:
                if not pool:
                    if first > last:
                        break
                    pool = windows[last][::-1]
                    last -= 1
                piece = pool.pop()
                if len(piece.ids) > self.window - level:
                    piece, rest = piece.cut(self.window - level)
                    pool.append(rest)
                pieces.append(piece)
                level += len(piece.ids)
            if level == self.window:
                self.emit(pieces)
            else:
                self._keep(pieces, level)
        if pool:
            self._keep(pool[::-1], sum(len(p.ids) for p in pool))

    def _keep(self, pieces: list[_Piece], level: int) -> None:
        self.open[level].append(pieces)
        self.counts[level] += 1
        self.n_open += 1

    def close(self) -> None:
        self.pour()
        for level in range(self.window - 1, 0, -1):
            for pieces in self.open[level]:
                pool = pieces[::-1]
                for bit in range(level.bit_length() - 1, -1, -1):
                    need, out = level & (1 << bit), []
                    while need:
                        piece = pool.pop()
                        if len(piece.ids) > need:
                            piece, rest = piece.cut(need)
                            pool.append(rest)
                        out.append(piece)
                        need -= len(piece.ids)
                    if out:
                        self.emit(out)
        self.open = [[] for _ in range(self.window)]


def pack(
    documents: DataFrame,
    vocabulary: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    max_open: int = MAX_OPEN,
) -> DataFrame:
    """Pieces of all documents: id, ``start`` in the document, ``length``, ``doc_tokens``,
    ``sequence_id``, ``offset`` in it and ``ids`` (little-endian unsigned 32-bit)."""
    source = documents.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text"))
    kind = source.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(vocabulary, pattern)
        end = np.asarray([end_id], "<u4").tobytes()
        base = TaskContext.get().partitionId() * SEQUENCES
        rows: list[tuple] = []
        done = 0

        def emit(pieces: list[_Piece]) -> None:
            nonlocal done
            offset = 0
            for p in pieces:
                n = len(p.ids)
                rows.append((p.doc, p.start, n, p.total, base + done, offset, p.ids.tobytes()))
                offset += n
            done += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            arrays = [pa.array(columns[0], doc_type)]
            arrays += [pa.array(c, pa.int64()) for c in columns[1:6]]
            arrays.append(pa.array(columns[6], pa.binary()))
            return pa.RecordBatch.from_arrays(
                arrays, ["doc", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
            )

        windows = SumOfSquares(window, emit, max_open)
        doc_type = None
        for batch in batches:
            doc_type = batch.schema.field(0).type
            for doc, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                windows.add(doc, np.frombuffer(encode(words.as_py() or "") + end, "<u4"))
                if len(rows) >= ROWS_OUT:
                    yield flush()
        windows.close()
        if rows:
            yield flush()
        del encode, windows
        hand_back()

    packed = source.mapInArrow(run, schema)
    return packed.withColumnRenamed("doc", doc_id)
