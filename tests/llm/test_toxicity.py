import itertools
import random

import numpy as np
import pytest

from siftwell.llm import toxicity


def brute_kernel(s, t, order=toxicity.ORDER, decay=toxicity.DECAY):
    total = 0.0
    for i in itertools.combinations(range(len(s)), order):
        for j in itertools.combinations(range(len(t)), order):
            if all(s[a] == t[b] for a, b in zip(i, j)):
                total += decay ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
    return total


@pytest.mark.parametrize(("s", "t"), [("idiot", "id-iot"), ("abcabc", "acb"), ("ab", "abc"), ("aaaa", "aaa"), ("xyz", "abc"), ("éñé", "éñé")])
def test_kernel_counts_gapped_subsequences(s, t):
    a, _ = toxicity._codes([s])
    b, _ = toxicity._codes([t])
    got = toxicity.subsequence_kernel(a, b[None, :, :])[0, 0]
    assert got == pytest.approx(brute_kernel(s, t), rel=1e-4)


def test_kernel_is_one_for_equal_strings():
    k = toxicity.normalised(["idiot", "id", "trash"], ["idiot", "trash"])
    assert k[0, 0] == pytest.approx(1, rel=1e-4) and k[2, 1] == pytest.approx(1, rel=1e-4)
    assert k[1].tolist() == [0, 0] and 0 <= k[0, 1] < 0.2


def test_spans():
    assert toxicity.span_of("**Idiot!!") == "idiot"
    assert toxicity.spelled("you i d i o t there a b") == ["idiot"]
    assert all(len(p) <= toxicity.SPAN for p in toxicity.pieces("x" * 1000))
    assert {c for p in toxicity.pieces("".join(map(chr, range(200, 300)))) for c in p} == set(map(chr, range(200, 300)))


INSULTS = ["idiot", "stupid", "disgusting", "scum"]


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    parts = "the ning ver sto lla mi que ren der ing bal tor".split()
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(20, 60))]
        toxic = i % 4 == 0
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        text = " ".join(w + ("." if k % 9 == 8 else "") for k, w in enumerate(words))
        rows.append((i, text))
        labels.append((i, int(toxic) if rng.random() > 0.03 else int(not toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark, docs):
    rows, labels = corpus()
    return toxicity.train(docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_accuracy(spark, docs, model):
    rows, _ = corpus(seed=7)
    got = {r["doc_id"]: r["score"] >= 0.3 for r in toxicity.score(docs(rows), model).collect()}
    assert sum(got[i] == (i % 4 == 0) for i in got) / len(got) > 0.98


def test_inserted_and_gapped_insults(spark, docs, model):
    toxic = ["you stu-pid one", "a di*sgus*ting thing", "i d i o t", "s.c.u.m", "what an iddiot", "Stupid!!", "**scum**"]
    clean = ["the ning ver", "", None, " \n", "a b c d e f", "\u0000", "12 34"]
    rows = list(enumerate(toxic)) + [(100 + i, t) for i, t in enumerate(clean)] + [(0, toxic[0]), (None, clean[0])]
    got = [(r["doc_id"], r["score"]) for r in toxicity.score(docs(rows), model).collect()]
    assert all(0 <= s <= 1 for _, s in got) and len(got) == len(rows)
    assert {i for i, s in got if s >= 0.3} == set(range(len(toxic)))
    long = toxicity.score(docs([(1, "the ning " * 50_000 + "scum"), (2, "the ning " * 50_000), (3, "x" * 100_000)]), model)
    assert {r["doc_id"] for r in long.collect() if r["score"] >= 0.3} == {1}


@pytest.mark.parametrize("count", [60, 200])
def test_many_insults_are_all_found(spark, docs, count):
    rng = random.Random(count)
    insults = ["".join(rng.choice("abcdefghijkmopuvwxyz") for _ in range(rng.randrange(6, 10))) for _ in range(count)]
    parts = "the ning ver sto lla mi que ren der ing bal tor".split()
    clean = lambda n: ["".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(n)]
    rows, labels = [], []
    for i in range(8 * count):
        words = clean(30)
        for k in range(8 * (i % 4 == 0)):
            words.insert(rng.randrange(len(words)), insults[(2 * i + k) % count])
        rows.append((i, " ".join(w + ("." if k % 9 == 8 else "") for k, w in enumerate(words))))
        labels.append((i, int(i % 4 == 0)))
    model = toxicity.train(docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    fresh = [(i, " ".join(clean(15) + [w] + clean(15))) for i, w in enumerate(insults)]
    fresh += [(1000 + i, " ".join(clean(30))) for i in range(200)]
    found = {r["doc_id"] for r in toxicity.score(docs(fresh), model).collect() if r["score"] >= 0.3}
    assert len(found & set(range(count))) > 0.97 * count
    assert len([i for i in found if i >= 1000]) < 5


def test_accepted_keeps_clean_documents(spark, docs, model):
    frame = docs([(1, "you scum"), (2, "the ning"), (3, None)])
    left = toxicity.accepted(frame, model)
    assert left.columns == frame.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3]


def test_without_examples(spark, docs):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, toxic int")
    frame = docs([(1, "a b c"), (2, "scum")])
    for labels in (empty, one):
        model = toxicity.train(frame, labels)
        assert len({r["score"] for r in toxicity.score(frame, model).collect()}) == 1
        assert toxicity.accepted(frame, model).count() == 2
    assert toxicity.score(docs([]), model).count() == 0


def test_logistic_follows_the_weights():
    x = np.array([-1.0, -1.0, 1.0, 1.0])
    slope, offset = toxicity._logistic(x, np.array([0.0, 0.0, 1.0, 0.0]), np.ones(4))
    assert 1 / (1 + np.exp(-(slope + offset))) == pytest.approx(0.5, abs=0.02)
