"""The qd solver against dense solvers, whitening against whole-table numpy and exact integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.llm import qdsolver, whitening


def same_directions(a, b, tolerance):
    return np.abs(np.abs(np.sum(a * b, axis=0)) - 1).max() < tolerance


@pytest.mark.parametrize("n", [1, 2, 3, 8, 64])
def test_random_matrices(n):
    rng = np.random.default_rng(n)
    for _ in range(5):
        a = rng.standard_normal((n + 10, n)) * rng.uniform(0.1, 10, n)
        value, vector = qdsolver.right_singular(np.linalg.qr(a, mode="r"))
        _, s, vt = np.linalg.svd(a)
        assert np.allclose(value, s, rtol=1e-13)
        assert np.abs(vector.T @ vector - np.eye(n)).max() < 1e-11
        assert same_directions(vector, vt.T, 1e-9)


@pytest.mark.parametrize(
    "values",
    [[3.0] * 12, [5, 5, 5, 1, 1, 1e-3], [1, 1 + 1e-12, 1 - 1e-12, 2, 2], [0, 0, 0], [4, 2, 0, 0], [1e9, 1, 1e-6], [1e150, 1e140]],
)
def test_equal_tiny_and_zero_values(values):
    rng = np.random.default_rng(5)
    n = len(values)
    left, right = (np.linalg.qr(rng.standard_normal((n, n)))[0] for _ in range(2))
    a = left @ np.diag(np.array(values, float)) @ right.T
    value, vector = qdsolver.right_singular(a)
    assert np.allclose(value, sorted(values, reverse=True), rtol=1e-10, atol=1e-14 * max(values))
    assert np.abs(vector.T @ vector - np.eye(n)).max() < 1e-10
    off = a @ vector
    assert np.abs(np.linalg.norm(off, axis=0) - value).max() <= 1e-12 * max(values)


def test_small_values_of_a_graded_bidiagonal_are_relatively_accurate():
    diagonal, upper = np.array([1.0, 1e-4, 1e-8, 1e-12]), np.array([1.0, 1e-4, 1e-8])
    value = np.sqrt(qdsolver.squared_values(diagonal, upper))
    assert math.isclose(value.prod(), diagonal.prod(), rel_tol=1e-13)


def brute(rows, components=32):
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(v) for _, v in rows), default=0)
    x = [[math.floor(64 * c) + 1_000_000 for c in [*v, *[0.0] * (dims - len(v))]] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(r, sums, strict=True)] for r in x])
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1], vector[:, ::-1]
    keep = min(components, int((value > 1e-9 * value[0]).sum()))
    return rows, n, deviation, centred @ vector[:, :keep] / np.sqrt(value[:keep]), (value / value.sum())[:keep]


def check(got, rows, **how):
    kept, n, deviation, white, explained = brute(rows, **how)
    assert len(got) == white.size
    table = np.array([r["whitened"] for r in sorted(got, key=lambda r: (r["vec_id"], r["component"]))]).reshape(white.shape)
    order = np.argsort([i for i, _ in kept], kind="stable")
    white = white[order]
    signs = np.sign(np.sum(table * white, axis=0))
    assert np.abs(table * signs - white).max() < 1e-7
    for r in got:
        at = [i for i, _ in kept].index(r["vec_id"])
        assert r["n"] == n and r["deviation"] == deviation[at]
        assert math.isclose(r["explained"], explained[r["component"] - 1], rel_tol=1e-9)
        assert r["identity_error"] < 1e-9


def frame(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return df.withColumns({c: F.lit("x") for c in ("id", "v", "part", "state", "n", "component")})


def test_against_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "ROWS", 7)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(40) * rng.uniform(0.5, 2)]) for i in range(150)]
    bad = [(900, None), (901, [float("nan")] * 40), (902, [float("inf")] + [0.0] * 39), (903, [None] + [0.0] * 39)]
    got = whitening.whiten(frame(spark, rows + bad).repartition(9)).collect()
    check(got, rows + bad)
    assert {r["component"] for r in got} == set(range(1, 33))


def test_few_dimensions_ragged_and_dependent(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [a, b, 3.0]) for i, (a, b) in enumerate(rng.standard_normal((40, 2)).tolist())]
    rows += [(100, [1.5]), (101, []), (102, [0.25, -7.0])]
    got = whitening.whiten(frame(spark, rows, "double")).collect()
    check(got, rows)
    doubled = [(i, [a, a, b]) for i, (a, b, _) in rows[:40]]
    assert {r["component"] for r in whitening.whiten(frame(spark, doubled, "double")).collect()} == {1, 2}


def test_repeated_rows_count(spark):
    rng = np.random.default_rng(6)
    rows = [(i, c) for i, c in enumerate(rng.standard_normal((30, 4)).tolist())]
    got = whitening.whiten(frame(spark, rows + rows[:5] * 20, "double")).collect()
    assert len(got) == 130 * 4 and {r["n"] for r in got} == {130}
    assert got[0]["identity_error"] < 1e-10


def test_large_components(spark):
    rng = np.random.default_rng(8)
    rows = [(i, c) for i, c in enumerate(rng.standard_normal((30, 3)).tolist())]
    got = whitening.whiten(frame(spark, rows + [(50, [1e9, 0.0, 0.0])], "double")).collect()
    assert len(got) == 31 * 3 and got[0]["identity_error"] < 1e-4
    exact = brute(rows + [(50, [1e9, 0.0, 0.0])])[2]
    assert {r["deviation"] for r in got} == {d if d < 2**63 else None for d in exact}
    got = whitening.whiten(frame(spark, rows + [(50, [1e300, 0.0, -1e300])], "double")).collect()
    assert len(got) >= 31 and all(math.isfinite(r["whitened"]) for r in got)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    df = whitening.whiten(frame(spark, rows, "double"))
    assert df.collect() == [] and "identity_error" in df.columns


def test_null_id_stays(spark):
    got = whitening.whiten(frame(spark, [(None, [1.0]), (1, [2.0])], "double")).collect()
    assert {r["vec_id"] for r in got} == {None, 1} and {abs(round(r["whitened"], 9)) for r in got} == {1.0}
