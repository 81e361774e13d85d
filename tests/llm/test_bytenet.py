"""The network against numerical slopes and a plain loop, and its accuracy on held-out documents."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftwell.llm import bytenet

TEXTS = [None, "", "a", "é" * 300, "word " * 2000, "x" * 111, "x" * 128, "x" * 129, "The end. " * 50]


def column(texts):
    return pa.array([None if t is None else t.encode() for t in texts], pa.binary())


def slow_score(text, weights):
    """One filter place after another."""
    raw = (text or "").encode()
    own = []
    for at in range(0, max(1, len(raw) - (bytenet.CHUNK - bytenet.STEP)), bytenet.STEP):
        chunk = raw[at : at + bytenet.CHUNK]
        chunk = chunk + bytes([bytenet.FILLING]) * (bytenet.CHUNK - len(chunk))
        best = np.full(bytenet.FILTERS, -np.inf)
        for k in range(0, bytenet.CHUNK - bytenet.WIDTH + 1, 2):
            seen = np.concatenate([weights["byte"][b] for b in chunk[k : k + bytenet.WIDTH]])
            best = np.maximum(best, seen @ weights["filter"])
        kept = np.maximum(best + weights["filter_bias"], 0)
        own.append(np.maximum(kept @ weights["layer"] + weights["layer_bias"], 0))
    line = np.concatenate([np.mean(own, 0), np.max(own, 0)]) @ weights["out"] + weights["out_bias"][0]
    return 1 / (1 + np.exp(-line))


@pytest.mark.parametrize("at_once", [1, 7, 96])
def test_scores_are_those_of_a_plain_loop(monkeypatch, at_once):
    monkeypatch.setattr(bytenet, "AT_ONCE", at_once)
    weights = bytenet.first_weights()
    got = bytenet.scores(column(TEXTS), weights)
    assert np.allclose(got, [slow_score(t, weights) for t in TEXTS], atol=1e-5)
    assert np.allclose(bytenet.scores(column(TEXTS).slice(3, 4), weights), got[3:7], atol=1e-6)
    assert len(bytenet.scores(column([]), weights)) == 0


def test_chunks_overlap_and_cover_every_byte():
    for size in [*range(0, 600), 5000, 70_001]:
        starts = bytenet.chunk_starts(size)
        assert starts[0] == 0 and starts[-1] + bytenet.CHUNK >= size
        assert (np.diff(starts) == bytenet.STEP).all() and bytenet.CHUNK - bytenet.STEP >= bytenet.WIDTH
        assert len(starts) == 1 or starts[-1] < size


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    weights = {k: v.astype(np.float64) for k, v in bytenet.first_weights().items()}
    chunks = rng.integers(0, 200, (7, bytenet.CHUNK)).astype(np.uint8)
    chunks[3, 40:] = bytenet.FILLING
    first, good, cost = np.array([0, 1, 4]), np.array([1.0, 0.0, 1.0]), np.array([0.3, 1.0, 0.7])
    _, grad = bytenet.gradients(chunks, first, good, cost, weights)
    for name, g in grad.items():
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in weights[name].shape)
            if name == "byte":
                at = (int(chunks[rng.integers(0, 3), rng.integers(0, 30)]), at[1])
            moved = []
            for step in (1e-6, -1e-6):
                other = {k: v.copy() for k, v in weights.items()}
                other[name][at] += step
                moved.append(bytenet.gradients(chunks, first, good, cost, other)[0])
            assert abs((moved[0] - moved[1]) / 2e-6 - g[at]) < 1e-3 * max(1, abs(g[at]))


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeionrst") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(5, 400))) + "."
        good = i % 4 > 0
        if not good:
            text = text.upper() if i % 8 else text.replace(" ", "%%% ")
        rows.append((i, text, int(good)))
    return rows


@pytest.fixture(scope="module")
def trained(spark):
    rows = corpus(400, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    return rows, docs, labels, bytenet.train(docs, labels, learn=F.col("doc_id") < 300, rounds=4)


def test_held_out_accuracy(trained):
    rows, docs, _, model = trained
    got = {r["doc_id"]: r["score"] for r in bytenet.score(docs, model).collect()}
    held = [(got[i], good) for i, _, good in rows if i >= 300]
    assert sum((s >= 0.5) == bool(g) for s, g in held) >= 0.97 * len(held)


def test_training_is_repeatable(trained):
    _, docs, labels, model = trained
    again = bytenet.train(docs.repartition(5), labels.repartition(3), learn=F.col("doc_id") < 300, rounds=4)
    assert all(np.array_equal(model.weights[k], again.weights[k]) for k in model.weights)


def test_hard_rows(trained, docs):
    _, _, _, model = trained
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a"), (1, "a"), (1, "a")]
    got = bytenet.score(docs(rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert len({round(r["score"], 6) for r in got if r["doc_id"] in (0, 1)}) <= 2
    assert bytenet.score(docs([]), model).collect() == []


@pytest.mark.parametrize("labels, share", [([], 0.5), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0), ([(1, None), (None, 1)], 0.5), ([(8, 1), (9, 0)], 0.5)])
def test_one_kind_of_label_gives_its_share(spark, docs, labels, share):
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    texts = docs([(1, "a"), (2, None)])
    model = bytenet.train(texts, table)
    assert {r["score"] for r in bytenet.score(texts, model).collect()} == {share}


def test_labels_that_disagree_and_repeated_rows(spark, docs):
    table = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, 1)], "doc_id long, quality int")
    model = bytenet.train(docs([(1, "a"), (1, "a"), (2, "b"), (2, "c"), (3, "d")]), table, rounds=1)
    assert model.weights is not None and model.share == 0.5
