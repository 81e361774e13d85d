"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to whole numbers. The index holds blocks of rows; in a block every bit of
every component is one bitmap over the rows (components are shifted to be non-negative). The score
of a query is a sum of shifted slices: bit k of the query's component times bit j of the rows'
component weighs 2^(j+k). Slices of equal weight are added with bitmap arithmetic: a full adder
turns three bitmaps into a sum and a carry, until one bitmap per weight is left, which are the
slices of the score. A negative query component takes the complement of the slices instead; the
shifts change all scores of a query by the same number.

The top rows are read from the most significant slice downward: rows with the bit set are taken if
there are no more than k, else the others are dropped. Rows equal in all slices at the boundary are
resolved by the smaller id. A block returns at most k rows per query, and the k best over all
blocks are kept, so the result is exact.

Queries are a stated set of rows. Blocks of queries are sent to every block of rows by the block's
number; a task holds one block of rows and reads the queries after it, block by block, whatever the
tables hold.

Every finite component takes part, whatever its size. If a sum of products might leave 63 bits, the
slices are cut from whole numbers of any length, blocks are smaller in proportion to the slices, and
the order stays exact; a score that a long cannot hold is null.

Cases: vectors that are null, or hold a null or non-finite component, take no part, neither do rows
with a null id. All vectors need the same length; others are refused with an error. If rows repeat
an id, each takes part, queries of one id share one list, and none meets rows with its own id. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.runtime import cut_lineage

SCALE = 64
TOP = 20
ROWS_IN_BLOCK = 32_768
QUERIES_IN_BLOCK = 128


def sound_vectors(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(``id``, ``v`` array<double>) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    # Null, NaN and infinities differ from zero, or from themselves, when taken from themselves.
    sound = F.forall(v, lambda x: F.coalesce(x - x == 0, F.lit(False)))
    rows = vectors.where(F.col(vec_id).isNotNull() & v.isNotNull() & sound)
    return rows.select(F.col(vec_id).cast("long").alias("id"), v.alias("v"))


def whole_number(x: float, scale: int) -> int:
    """floor(scale * x) for any finite x."""
    return int(x) * scale if abs(x) >= 2.0**53 else math.floor(scale * x)


def whole_numbers(v: np.ndarray, scale: int) -> np.ndarray:
    """``whole_number`` of every component, as Python numbers."""
    return np.array([whole_number(x, scale) for x in v.ravel().tolist()], object).reshape(v.shape)


def slices_of(values: np.ndarray, low: int, bits: int) -> np.ndarray:
    """Bitmaps (components, bits, words of 64 rows) of ``values`` (rows, components) minus ``low``."""
    rows, dims = values.shape
    words = -(-rows // 64)
    shifted = np.zeros((words * 64, dims), values.dtype if values.dtype == object else np.int64)
    shifted[:rows] = values - low
    out = np.empty((dims, bits, words), np.uint64)
    for b in range(bits):
        packed = np.packbits(((shifted >> b) & 1).astype(np.uint8), axis=0, bitorder="little")
        out[:, b] = np.ascontiguousarray(packed.T).view("<u8")
    return out


def add_slices(by_weight: dict[int, list[np.ndarray]]) -> list[np.ndarray | None]:
    """Sum of bitmaps that weigh 2^w, as slices from the least significant on. Bitmaps are stacks
    (count, words); the lists are used up."""
    out: list[np.ndarray | None] = []
    w = 0
    while any(k >= w and v for k, v in by_weight.items()):
        stack = by_weight.pop(w, [])
        maps = np.concatenate(stack) if stack else None
        while maps is not None and len(maps) > 1:
            third = len(maps) // 3
            if third:
                a, b, c = maps[:third], maps[third : 2 * third], maps[2 * third : 3 * third]
                half = a ^ b
                carry = (a & b) | (half & c)
                maps = np.concatenate([half ^ c, maps[3 * third :]])
            else:
                carry = maps[:1] & maps[1:2]
                maps = maps[:1] ^ maps[1:2]
            by_weight.setdefault(w + 1, []).append(carry)
        out.append(None if maps is None else maps[0])
        w += 1
    return out


def score_slices(index: np.ndarray, query: np.ndarray) -> list[np.ndarray | None]:
    """Slices of the score of all rows of a block, up to a shift that all rows share."""
    by_weight: dict[int, list[np.ndarray]] = {}
    size = np.abs(query)
    above, below = (query > 0).astype(bool), (query < 0).astype(bool)
    for k in range(int(max(size, default=0)).bit_length()):
        has = ((size >> k) & 1 == 1).astype(bool)
        for part, turn in ((has & above, False), (has & below, True)):
            if not part.any():
                continue
            for j in range(index.shape[1]):
                maps = index[part, j]
                by_weight.setdefault(j + k, []).append(~maps if turn else maps)
    return add_slices(by_weight)


def bits_at(bitmap: np.ndarray) -> np.ndarray:
    """Rows whose bit is set."""
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_rows(slices: list[np.ndarray | None], among: np.ndarray, k: int) -> np.ndarray:
    """Rows with the k largest scores; at the boundary the lowest rows win."""
    sure, open_ = np.zeros_like(among), among
    n_sure = 0
    for s in reversed(slices):
        with_bit = np.zeros_like(among) if s is None else open_ & s
        n = n_sure + int(np.bitwise_count(with_bit).sum())
        if n > k:
            open_ = with_bit
        else:
            sure, n_sure = sure | with_bit, n
            open_ = open_ ^ with_bit
            if n == k:
                return bits_at(sure)
    return np.concatenate([bits_at(sure), bits_at(open_)[: k - n_sure]])


def block_top(ids: np.ndarray, values: np.ndarray, index: np.ndarray, query_ids, queries, k: int):
    """(query, row id, score) of the best rows of a block for each query. Rows are sorted by id."""
    every = np.packbits(np.arange(index.shape[2] * 64) < len(ids), bitorder="little").view("<u8")
    for qid, q in zip(query_ids, queries, strict=True):
        among = every
        own = np.arange(np.searchsorted(ids, qid), np.searchsorted(ids, qid, side="right"))
        if len(own):
            among = every.copy()
            np.bitwise_and.at(among, own >> 6, ~(np.uint64(1) << (own & 63).astype(np.uint64)))
        rows = top_rows(score_slices(index, q), among, k)
        chosen = values[rows]
        yield qid, ids[rows], (chosen if chosen.dtype == object else chosen.astype(np.int64)) @ q


def _blocks(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Rows gathered into blocks of about ``size``: (``block``, ``ids`` long[], ``values`` int[][]),
    and the number of blocks."""
    count = max(1, -(-rows.count() // size))
    number = F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")
    packed = rows.groupBy(number.alias("block")).agg(F.array_sort(F.collect_list(F.struct("id", "v"))).alias("r"))
    return packed.select("block", F.col("r.id").alias("ids"), F.col("r.v").alias("values")), count


def exact_top(
    vectors: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = TOP,
    scale: int = SCALE,
    rows_in_block: int = ROWS_IN_BLOCK,
    queries_in_block: int = QUERIES_IN_BLOCK,
) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): the k best rows for each row of ``is_query``."""
    rows = sound_vectors(vectors, vec_id, vector)
    shape = rows.agg(
        F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high"),
        F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most"),
    ).first()
    spark = vectors.sparkSession
    if shape["least"] != shape["most"]:
        raise ValueError("vectors differ in length")
    if not shape["least"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    low, high = (whole_number(shape[x], scale) for x in ("low", "high"))
    bits = max(1, (high - low).bit_length())
    largest = max(abs(low), abs(high))
    # Numbers of any length are cut from the doubles where the blocks are.
    wide = largest >= 2**31 or shape["most"] * largest**2 >= 2**63
    if wide:
        rows_in_block = max(64, rows_in_block * 32 // max(bits, 32))
    else:
        rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(F.lit(scale) * x).cast("int")))
    rows = cut_lineage(rows)
    # Scores of any length are ordered as bytes.
    n_bytes = (shape["most"] * largest**2).bit_length() // 8 + 1
    zero = 1 << (8 * n_bytes - 1)
    names = ["query_id", "vec_id", "score"] + ["size"] * wide

    bases, n_blocks = _blocks(rows, rows_in_block)
    asks, _ = _blocks(rows.where(is_query), queries_in_block)
    everywhere = asks.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    # The block itself comes first, then the queries that meet it.
    met = bases.withColumn("kind", F.lit(0)).unionByName(everywhere.withColumn("kind", F.lit(1)))
    met = met.repartition("block").sortWithinPartitions("block", "kind").select("kind", "ids", "values")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: tuple = ()
        for batch in batches:
            for r in range(batch.num_rows):
                ids = batch.column("ids")[r].values.to_numpy()
                values = batch.column("values")[r].values.flatten().to_numpy().reshape(len(ids), -1)
                if wide:
                    values = whole_numbers(values, scale)
                if batch.column("kind")[r].as_py() == 0:
                    block = (ids, values, slices_of(values, low, bits))
                    continue
                out = list(block_top(*block, ids, values if wide else values.astype(np.int64), k))
                columns = [pa.array(np.repeat(ids, [len(x[1]) for x in out])), pa.array(np.concatenate([x[1] for x in out]))]
                scores = np.concatenate([x[2] for x in out])
                if wide:
                    columns.append(pa.array([x if -(2**63) <= x < 2**63 else None for x in scores], pa.int64()))
                    columns.append(pa.array([(x + zero).to_bytes(n_bytes, "big") for x in scores], pa.binary()))
                else:
                    columns.append(pa.array(scores))
                yield pa.RecordBatch.from_arrays(columns, names)

    best = met.mapInArrow(run, "query_id long, vec_id long, score long" + ", size binary" * wide)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(names[-1]), "vec_id"))
    return best.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
