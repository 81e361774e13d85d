"""Whitened embeddings from exact means, blockwise QR and a bidiagonal qd solver.

Entries c become whole numbers x = floor(scale * c) + shift. Three small passes and one wide one:

1. number of rows and sum of every dimension, as exact whole numbers;
2. every task takes its centred rows block by block into one triangular factor R (QR of R on top of
   the next block), and the tasks' factors are joined the same way, ``FAN`` at a time, so R'R is
   the sum of all rows' outer products and no matrix is ever squared;
   :mod:`~siftwell.llm.qdsolver` gives R's singular values and right singular vectors, which are the
   components and, squared and over n, their variances;
3. count, mean and centred products of the whitened rows, block by block, for the check against the
   identity;
4. the rows themselves.

What passes the driver is one sum per dimension and one small triangle; partial results of the
tasks are joined in groups of ``FAN`` neighbouring tasks, twice, before the driver joins the rest.
Every task can be run again from the input.

Cases: vectors that are null, or hold a null, NaN or infinite entry, are left out; of what is left
nothing is. x is cut at the ends of a long, as a cast is. A shorter vector counts as one with zeros
at its end. A null id stays null; repeated rows stay and count. Components without variance, as far
as double precision can tell, are not returned, so a table of equal vectors gives no rows, as an
empty table does. A deviation that a long can't hold is null. Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.batches import pieces
from siftwell.llm.qdsolver import EPS, right_singular

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
FAN = 32
# Rows of a block: a few MB for vectors of usual length.
ROWS = 4096
_LONG = 1 << 63
_EXACT = 1 << 52


def sound(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(``id``, ``v`` array<double>) of the rows whose entries are all finite numbers."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col(vec_id).alias("id"), v.alias("v")).where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull()) & finite)


def whole(column: pa.Array, dims: int, scale: int, shift: int) -> np.ndarray:
    """x of a column of vectors, (rows, dims); of Python integers where int64 might not hold sums."""
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    scaled = np.floor(np.clip(flat, -1e300, 1e300) * scale)
    out = np.zeros((len(column), dims))
    out[np.arange(dims)[None, :] < sizes[:, None]] = scaled
    if np.abs(out).max(initial=0) < _EXACT:
        return out.astype(np.int64) + shift
    long = [[min(max(int(x) + shift, -_LONG), _LONG - 1) for x in row] for row in out.tolist()]
    return np.array(long, object).reshape(out.shape)


@dataclass(frozen=True)
class Moments:
    """Rows, and for every dimension the whole part of the mean and what the division leaves."""

    n: int
    base: tuple[int, ...]
    rest: tuple[int, ...]

    def from_base(self, x: np.ndarray) -> np.ndarray:
        """x less the whole part of the mean, exact."""
        if x.dtype != object and max(map(abs, self.base), default=0) < 2 * _EXACT:
            return x - np.array(self.base, np.int64)
        return x.astype(object) - np.array(self.base, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        part = np.array([r / self.n for r in self.rest])
        return self.from_base(x).astype(float) - part

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - sum)^2 over the dimensions."""
        far = self.from_base(x)
        reach = (int(np.abs(far).max(initial=0)) + 1) * self.n
        if far.shape[1] * reach * reach >= _LONG:
            far = far.astype(object)
        off = far * self.n - np.array(self.rest, far.dtype)
        return [v if v < _LONG else None for v in (off * off).sum(axis=1).tolist()] if far.shape[1] else [0] * len(x)


@dataclass(frozen=True)
class Whitening:
    """Directions over their standard deviations, as columns, and each one's part of the variance."""

    moments: Moments
    matrix: np.ndarray
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.moments.centred(x) @ self.matrix


State = Any


def gathered(rows: DataFrame, add: Callable[[State, pa.Array], State], join: Callable[[State, State], State]) -> State:
    """One state over all vectors: every task adds its blocks, then states are joined in groups."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for part in pieces(batch, ROWS):
                state = add(state, part.column("v"))
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(state)], pa.binary())], ["state"])

    def several(table: pa.Table) -> pa.Table:
        state = None
        ordered = table.sort_by("part")
        for blob in ordered.column("state").to_pylist():
            state = pickle.loads(blob) if state is None else join(state, pickle.loads(blob))
        return pa.table({"part": pa.array([ordered.column("part")[0].as_py() // FAN], pa.int32()), "state": pa.array([pickle.dumps(state)], pa.binary())})

    states = rows.mapInArrow(one, "state binary").select(F.spark_partition_id().alias("part"), "state")
    for _ in range(2):
        states = states.groupBy((F.col("part") / FAN).cast("int").alias("key")).applyInArrow(several, "part int, state binary")
    total = None
    # One state for FAN * FAN tasks.
    for row in sorted(states.collect(), key=lambda r: r["part"]):
        total = pickle.loads(row["state"]) if total is None else join(total, pickle.loads(row["state"]))
    return total


def moments(rows: DataFrame, scale: int, shift: int) -> Moments:
    def padded(sums: list[int], dims: int, n: int) -> list[int]:
        return sums + [n * shift] * (dims - len(sums))

    def join(a: State, b: State) -> State:
        dims = max(len(a[1]), len(b[1]))
        left, right = padded(a[1], dims, a[0]), padded(b[1], dims, b[0])
        return a[0] + b[0], [x + y for x, y in zip(left, right, strict=True)]

    def add(state: State, column: pa.Array) -> State:
        if not len(column):
            return state
        dims = int(np.diff(column.offsets.to_numpy()).max())
        own = (len(column), [int(s) for s in whole(column, dims, scale, shift).sum(axis=0).tolist()])
        return own if state is None else join(state, own)

    n, sums = gathered(rows, add, join) or (0, [])
    pairs = [divmod(s, n) for s in sums]
    return Moments(n, tuple(p[0] for p in pairs), tuple(p[1] for p in pairs))


def triangle(rows: DataFrame, mean: Moments, scale: int, shift: int) -> np.ndarray:
    """R with R'R = sum of the outer products of the centred rows."""
    dims = len(mean.base)

    def add(state: State, column: pa.Array) -> State:
        block = mean.centred(whole(column, dims, scale, shift))
        return np.linalg.qr(block if state is None else np.vstack([state, block]), mode="r")

    def join(a: State, b: State) -> State:
        return np.linalg.qr(np.vstack([a, b]), mode="r")

    return gathered(rows, add, join)


def fit(rows: DataFrame, components: int, scale: int, shift: int) -> Whitening | None:
    mean = moments(rows, scale, shift)
    if not mean.n or not mean.base:
        return None
    value, vector = right_singular(triangle(rows, mean, scale, shift))
    # Below this, a value is what rounding leaves of a dimension that the others determine.
    real = int((value > 16 * len(value) * EPS * value.max(initial=0.0)).sum())
    if not real:
        return None
    keep = min(components, real)
    part = (value / value[0]) ** 2
    return Whitening(mean, vector[:, :keep] * (np.sqrt(mean.n) / value[:keep]), (part / part.sum())[:keep])


def distance_from_identity(rows: DataFrame, model: Whitening, scale: int, shift: int) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    dims = len(model.moments.base)

    def join(a: State, b: State) -> State:
        n, far = a[0] + b[0], b[1] - a[1]
        return n, a[1] + far * (b[0] / n), a[2] + b[2] + np.outer(far, far) * (a[0] * b[0] / n)

    def add(state: State, column: pa.Array) -> State:
        if not len(column):
            return state
        w = model.apply(whole(column, dims, scale, shift))
        mean = w.mean(axis=0)
        own = (len(w), mean, (w - mean).T @ (w - mean))
        return own if state is None else join(state, own)

    n, _, products = gathered(rows, add, join)
    return float(np.abs(products / n - np.eye(products.shape[0])).max())


def whiten(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """(id, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``)."""
    rows = sound(vectors, vec_id, vector)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(rows, components, scale, shift)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", vec_id)
    error = distance_from_identity(rows, model, scale, shift)
    dims, keep = len(model.moments.base), len(model.explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, ROWS):
                x = whole(part.column("v"), dims, scale, shift)
                each = np.repeat(np.arange(len(x)), keep)
                columns = [
                    part.column("id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), model.moments.n)),
                    pa.array(model.moments.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(model.apply(x).ravel()),
                    pa.array(np.tile(model.explained, len(x))),
                    pa.array(np.full(len(each), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", vec_id)
