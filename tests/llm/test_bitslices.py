import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.llm import bitslices


def brute(rows, k=20, every=20):
    whole = lambda x: int(x) * 64 if abs(x) >= 2.0**53 else math.floor(64 * x)
    sound = [
        (i, [whole(x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, q in sound:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in sound if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("rows_in_block", [bitslices.ROWS_IN_BLOCK, 70])
def test_matches_brute_force(spark, rows_in_block):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 6)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(50)] + [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (402, [math.nan] * 6)]
    rows += [(403, [math.inf] * 6), (None, rows[0][1]), (420, [0.0] * 6), (440, [-5.0] * 6), (460, [9.0, -9.0, 0.1, 0.1, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x"))
    got = bitslices.exact_top(frame, F.col("id") % 20 == 0, rows_in_block=rows_in_block, queries_in_block=3)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_few_rows_and_empty(spark):
    frame = spark.createDataFrame([(0, [0.5, 1.0]), (20, [0.5, 1.0]), (3, [0.0, 0.0])], "vec_id long, embedding array<float>")
    got = bitslices.exact_top(frame, F.col("id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 20, 5120), (0, 2, 3, 0), (20, 1, 0, 5120), (20, 2, 3, 0)]
    assert bitslices.exact_top(frame.limit(0), F.col("id") % 20 == 0).count() == 0
    uneven = spark.createDataFrame([(0, [0.5]), (20, [0.5, 1.0])], "vec_id long, embedding array<float>")
    with pytest.raises(ValueError):
        bitslices.exact_top(uneven, F.col("id") % 20 == 0)


@pytest.mark.parametrize("large", [3e7, 1e9, 1e12, 1e300, 1.7e308])
def test_large_components_take_part(spark, large):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 3)]) for i in range(90)]
    rows += [(100, [large, 0.5, -large]), (101, [-large, 1.0, 2.0]), (102, [large, 0.5, 0.0]), (120, [0.0, -0.01, large])]
    rows += [(103, [large, 0.5, -large]), (104, [math.inf, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = bitslices.exact_top(frame, F.col("id") % 20 == 0, rows_in_block=400)
    want = [(q, r, i, s if -(2**63) <= s < 2**63 else None) for q, r, i, s in brute(rows)]
    assert sorted(map(tuple, got.collect()), key=lambda x: x[:2]) == want
    assert {100, 101, 102, 103} <= {x[2] for x in want}


@pytest.mark.parametrize("seed", range(5))
def test_score_slices_hold_the_score(seed):
    rng = np.random.default_rng(seed)
    values = rng.integers(-40, 40, (130, 9))
    query = rng.integers(-40, 40, 9)
    slices = bitslices.score_slices(bitslices.slices_of(values, -40, 7), query)
    total = np.zeros(192, np.int64)
    for w, s in enumerate(slices):
        if s is not None:
            total += np.unpackbits(s.view(np.uint8), bitorder="little").astype(np.int64) << w
    assert len(set((total[:130] - values @ query).tolist())) == 1
