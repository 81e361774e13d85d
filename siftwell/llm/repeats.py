"""Periodic runs in the words of a text, caught square by square as the words are appended.

A run is a longest stretch of words that repeats with some smallest period, at least twice. It holds
squares (a block followed by itself), and every square whose half has 2B to 4B - 1 words, B a power
of two, holds a whole block [bB, (b+1)B) in its left half. So each completed block of B words is a
catcher: it waits for the words that lie 2B to 4B - 1 later, and each appended word is compared,
as the end of a suffix of B words, with the two catchers of every B whose turn it is. A catch at
distance q says that words q apart are equal over the block; the stretch of equal words is
extended to the left once, and to the right as far as words are there, and goes on with later
words. As soon as it is q words long a square has appeared; the squares of one stretch merge into
one run. Words q = 1 apart are compared directly.

Catches that lead nowhere new are left out: catchers next to each other that catch at the same
distance belong to one stretch, and a block inside a run of period p, with room for two periods,
cannot give a new run at a multiple of p within that run.

Suffixes are compared by hashes modulo a prime, for all appended words at once. Every run is
compared word by word before it is returned; should two different stretches have had equal hashes,
all is done again with another base. So results are exact.

Texts are handled in groups of about ``GROUP`` bytes; texts of similar length form one sequence,
parted by words that occur once, so that no run spans two texts. A very long text is a group of its
own and takes memory in proportion to its length and time in proportion to length times its
logarithm. Nothing is shuffled; every row is judged by itself, so a lost executor only means that
its rows are read again.

Cases: a null or empty text, or one of white space, has no words and no runs. Repeated rows are
judged each. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 214_013, 69_069, 1_664_525, 22_695_477, 1_566_083_941)
SHORTEST = 12
GROUP = 2 << 20

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

Rewrite = Callable[[object, int], "np.ndarray | None"]


class EqualHashes(Exception):
    """Two different stretches have the same hash."""


class Catchers:
    """Catchers over an append-only sequence of word numbers from 0 to PRIME - 2."""

    def __init__(self, base: int = BASES[0], shortest: int = SHORTEST):
        self.base, self.shortest = base, shortest
        self.words = np.zeros(0, np.int64)
        self._prefix = np.zeros(1, np.int64)
        self._power = np.ones(1, np.int64)
        self._inverse = np.ones(1, np.int64)
        # Words first..last-1 equal those `period` words later.
        self.period = self.first = self.last = np.zeros(0, np.int64)

    def append(self, words: np.ndarray) -> np.ndarray:
        """Add words; returns (start, period) of the stretches that have become squares."""
        before = len(self.words)
        self._grow(np.asarray(words, np.int64))
        was = self.last - self.first
        going = self.last + self.period == before
        if going.any():
            at, q = self.last[going], self.period[going]
            self.last = self.last.copy()
            self.last[going] += self._ahead(at, at + q)
        at = np.arange(max(before, 1), len(self.words))
        at = at[self.words[at] == self.words[at - 1]]
        self._take(np.ones(len(at), np.int64), at - 1, 1, before)
        block = 1
        while 3 * block <= len(self.words):
            self._catch(block, before)
            block *= 2
        was = np.concatenate([was, np.zeros(len(self.period) - len(was), np.int64)])
        need, size = self._need(self.period), self.last - self.first
        fresh = (size >= need) & (was < need)
        found = np.stack([self.first[fresh], self.period[fresh]], 1)
        # Short stretches that a different word has ended are of no more use.
        keep = (size >= need) | (self.last + self.period == len(self.words))
        self.period, self.first, self.last = self.period[keep], self.first[keep], self.last[keep]
        return found

    def runs(self) -> np.ndarray:
        """(start, length, period) of all runs so far, by start and period."""
        first, end, period = self._squares()
        for a, b, q in zip(first.tolist(), end.tolist(), period.tolist(), strict=True):
            if not np.array_equal(self.words[a : b - q], self.words[a + q : b]):
                raise EqualHashes
        order = np.lexsort((period, first))
        return np.stack([first, end - first, period], 1)[order]

    def _need(self, period: np.ndarray) -> np.ndarray:
        """Least size of a stretch that makes a run."""
        return np.maximum(period, self.shortest - period)

    def _squares(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, end and period of the runs; of equal places the smallest period."""
        big = self.last - self.first >= self._need(self.period)
        first, end, period = self.first[big], (self.last + self.period)[big], self.period[big]
        order = np.lexsort((period, end, first))
        first, end, period = first[order], end[order], period[order]
        new = np.ones(len(first), bool)
        new[1:] = (first[1:] != first[:-1]) | (end[1:] != end[:-1])
        return first[new], end[new], period[new]

    def _grow(self, words: np.ndarray) -> None:
        old, n = len(self.words), len(self.words) + len(words)
        self.words = np.concatenate([self.words, words])
        for name, base in (("_power", self.base), ("_inverse", pow(self.base, -1, PRIME))):
            table = getattr(self, name)
            while len(table) <= n:
                table = np.concatenate([table, table * pow(base, len(table), PRIME) % PRIME])
            setattr(self, name, table)
        terms = (words + 1) * self._power[old:n] % PRIME
        self._prefix = np.concatenate([self._prefix, (np.cumsum(terms) + self._prefix[-1]) % PRIME])

    def _same(self, i: np.ndarray, j: np.ndarray, length: int) -> np.ndarray:
        """Whether the stretches of ``length`` words from i and from j have equal hashes (j > i)."""
        left = self._prefix[i + length] - self._prefix[i] + PRIME
        right = self._prefix[j + length] - self._prefix[j] + PRIME
        return left % PRIME * self._power[j - i] % PRIME == right % PRIME

    def _ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of words from i on that equal those from j on (j > i)."""
        room = len(self.words) - j
        size = np.zeros(len(i), np.int64)
        for bit in reversed(range(int(room.max(initial=0)).bit_length())):
            at = np.flatnonzero(size + (1 << bit) <= room)
            at = at[self._same((i + size)[at], (j + size)[at], 1 << bit)]
            size[at] += 1 << bit
        return size

    def _behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of words before i that equal those before j (j > i)."""
        size = np.zeros(len(i), np.int64)
        for bit in reversed(range(int(i.max(initial=0)).bit_length())):
            at = np.flatnonzero(size + (1 << bit) <= i)
            back = size[at] + (1 << bit)
            at = at[self._same(i[at] - back, j[at] - back, 1 << bit)]
            size[at] += 1 << bit
        return size

    def _catch(self, block: int, before: int) -> None:
        """Compare the suffixes of ``block`` words that end at new words with their two catchers."""
        n = len(self.words)
        low = max(before, 3 * block - 1)
        if low >= n:
            return
        diff = self._prefix[low + 1 : n + 1] - self._prefix[low + 1 - block : n + 1 - block] + PRIME
        suffix = diff % PRIME * self._inverse[low + 1 - block : n + 1 - block] % PRIME
        # Catcher b serves the words (b + 3) * block - 1 on, first as the near and then as the far one.
        start, stop = max(0, low + 1 - 4 * block) // block, (n - 3 * block) // block + 1
        edge = self._prefix[start * block : (stop + 1) * block : block]
        diff = edge[1 : stop - start + 1] - edge[: stop - start] + PRIME
        caught = np.repeat(diff % PRIME * self._inverse[start * block : stop * block : block] % PRIME, block)
        ends, periods = [], []
        for turn in (3, 4):
            at = max(low, turn * block - 1)
            if at < n:
                offset = at + 1 - turn * block - start * block
                hit = np.flatnonzero(suffix[at - low :] == caught[offset : offset + n - at]) + at
                end = ((hit + 1) // block - (turn - 1)) * block - 1
                ends.append(end)
                periods.append(hit - end)
        self._take(np.concatenate(periods), np.concatenate(ends), block, before)

    def _take(self, q: np.ndarray, end: np.ndarray, block: int, before: int) -> None:
        """Turn catches (distance, last word of the block) into stretches of equal words."""
        if len(q) and len(self.period):
            within = self._inside_runs(q, end, block)
            if before:
                within |= self._known(q, end, block)
            q, end = q[~within], end[~within]
        if not len(q):
            return
        order = np.lexsort((end, q))
        q, end = q[order], end[order]
        head = np.ones(len(q), bool)
        head[1:] = (q[1:] != q[:-1]) | (end[1:] - end[:-1] != block)
        at = np.flatnonzero(head)
        count = np.diff(np.append(at, len(q)))
        q, end, stop = q[at], end[at], end[at + count - 1]
        # The blocks before and after did not catch.
        able = ((count + 2) * block - 2 >= self._need(q)) | (stop + q + block >= len(self.words))
        q, end, stop = q[able], end[able], stop[able]
        first = end + 1 - block
        first = first - self._behind(first, first + q)
        last = end + 1 + self._ahead(end + 1, end + 1 + q)
        if (last <= stop).any():
            raise EqualHashes
        keep = (last - first >= self._need(q)) | (last + q == len(self.words))
        self.period = np.concatenate([self.period, q[keep]])
        self.first = np.concatenate([self.first, first[keep]])
        self.last = np.concatenate([self.last, last[keep]])

    def _inside_runs(self, q: np.ndarray, end: np.ndarray, block: int) -> np.ndarray:
        """Catches of a block and its copy that lie in one run, a multiple of its period apart."""
        first, stop, period = self._squares()
        short = (2 * period <= block) & (stop - first >= 3 * block)
        first, stop, period = first[short], stop[short], period[short]
        if not len(first):
            return np.zeros(len(q), bool)
        # A block with room for two periods lies in one such run only.
        low, high = -(-first // block), stop // block
        count = np.maximum(high - low, 0)
        run_of = np.full(len(self.words) // block + 1, -1, np.int64)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        run_of[place] = np.repeat(np.arange(len(first)), count)
        run = run_of[(end + 1) // block - 1]
        return (run >= 0) & (q % period[run] == 0) & (end + q < stop[run])

    def _known(self, q: np.ndarray, end: np.ndarray, block: int) -> np.ndarray:
        """Catches that belong to a stretch found when earlier words were appended."""
        order = np.lexsort((self.first, self.period))
        size = len(self.words) + 1
        key = (self.period * size + self.first)[order]
        at = np.searchsorted(key, q * size + end + 1 - block, side="right") - 1
        near = order[np.maximum(at, 0)]
        return (at >= 0) & (self.period[near] == q) & (end < self.last[near])


def runs_of(words: np.ndarray, shortest: int = SHORTEST) -> np.ndarray:
    """(start, length, period) of all runs of a sequence of word numbers."""
    for base in BASES:
        found = Catchers(base, shortest)
        try:
            found.append(words)
            return found.runs()
        except EqualHashes:
            continue
    raise RuntimeError("equal hashes with every base")


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside all runs and those of each run's first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def judge(rows: list[tuple[object, bytes | None]], rewrite: Rewrite | None, shortest: int) -> list[tuple[np.ndarray, bytes]]:
    """Runs and collapsed text of every (id, text)."""
    words = []
    for key, text in rows:
        # bytes.split() parts at space and \x09-\x0D, nothing else.
        own = (text or b"").split()
        order = rewrite(key, len(own)) if rewrite else None
        words.append(own if order is None else [own[i] for i in order.tolist()])
    found: list = [None] * len(rows)
    classes: dict[int, list[int]] = {}
    for i, own in enumerate(words):
        classes.setdefault(len(own).bit_length() // 2, []).append(i)
    for members in classes.values():
        every = [w for i in members for w in words[i]]
        numbers = pa.array(every, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        sizes = np.array([len(words[i]) for i in members], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        sequence = np.empty(starts[-1], np.int64)
        parting = starts[1:] - 1
        inner = np.ones(starts[-1], bool)
        inner[parting] = False
        sequence[inner] = numbers
        sequence[parting] = len(every) + np.arange(len(members))
        runs = runs_of(sequence, shortest)
        cut = np.searchsorted(runs[:, 0], starts)
        for k, i in enumerate(members):
            own = runs[cut[k] : cut[k + 1]]
            own = own - np.array([starts[k], 0, 0]) if len(own) else own
            found[i] = (own, collapsed(words[i], own))
    return found


def find_runs(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    rewrite: Rewrite | None = None,
    shortest: int = SHORTEST,
) -> DataFrame:
    """(id, ``runs`` by start and period, ``collapsed`` text) of every row.

    ``rewrite(id, n)`` may give the numbers of the words to read in place of a text's n words.
    """
    source = documents.select(F.col(doc_id).alias("id"), F.col(text).cast("string").cast("binary").alias("body"))
    kind = source.schema["id"].dataType.simpleString()

    def groups(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
        at, total = 0, 0
        for i, size in enumerate(sizes):
            if i > at and total + size > GROUP:
                yield at, i
                at, total = i, 0
            total += size
        if at < len(sizes):
            yield at, len(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in groups(batch):
                part = batch.slice(a, b - a)
                rows = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True))
                got = judge(rows, rewrite, shortest)
                flat = np.concatenate([r for r, _ in got])
                offsets = np.concatenate([[0], np.cumsum([len(r) for r, _ in got])]).astype(np.int32)
                structs = pa.StructArray.from_arrays(
                    [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], fields=list(_RUN)
                )
                lists = pa.ListArray.from_arrays(pa.array(offsets), structs)
                texts = pa.array([t for _, t in got], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), lists, texts], ["id", "runs", "collapsed"])

    return source.mapInArrow(run, f"id {kind}, runs {RUNS}, collapsed string").withColumnRenamed("id", doc_id)


def echoing(key: object, n: int) -> np.ndarray | None:
    """Word numbers for the ids whose text the benchmark lets repeat itself, else None."""
    if key is None or not n:
        return None
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Number of runs, the longest one and digests of all runs and of the collapsed text."""
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    rows = found.withColumn("best", best)
    return rows.select(
        doc_id,
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.n div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
