"""Quality of a text by a convolutional network over its bytes, written and trained in numpy.

A text's UTF-8 bytes are cut into overlapping chunks of ``CHUNK`` bytes that together cover all of
it; what the last one lacks is filled up with a byte that UTF-8 never has. Every byte becomes a
learned vector, learned filters read ``WIDTH`` bytes at a time, and the largest answer of each
filter in a chunk is kept. A small layer turns these into features of the chunk; their mean and
maximum over all chunks of the document make one probability.

Training: a bounded sample of labelled documents is split into ``PARTS`` groups by a hash. In each
round every group goes on from the same weights for one pass over its documents (back-propagation,
Adam steps), as a Spark task, and the groups' weights are averaged. Classes weigh as they occur in
all labels, so scores are probabilities although the sample is not.

Bounds: at most ``DOCS`` documents of each label are learnt from, those with the smallest hashes of
their ids, and at most ``CHUNKS`` evenly spaced chunks of each. The driver holds the weights, some
5,000 numbers. Scoring reads every text whole, ``AT_ONCE`` chunks at a time, and shuffles nothing.

Cases: a null or empty text is one chunk of filling and gets the network's score for that. Labels
that are null are ignored; a document with several labels is good if all say so. Without examples
of both kinds every score is the share of good labels, 0.5 if there are none. Repeated rows stay.
Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.batches import pieces
from siftwell.runtime import cut_lineage

CHUNK = 128
STEP = 112
WIDTH = 8
FILLING = 255
BYTE_VECTOR = 8
FILTERS = 32
FEATURES = 16
DOCS = 1500
CHUNKS = 16
PARTS = 4
ROUNDS = 8
DOCS_IN_STEP = 16
RATE = 0.01
AT_ONCE = 96
THRESHOLD = 0.3

Weights = dict[str, np.ndarray]


def first_weights() -> Weights:
    rng = np.random.default_rng(11)

    def some(*shape: int, fan: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(fan)).astype(np.float32)

    byte = some(256, BYTE_VECTOR, fan=2)
    byte[FILLING] = 0
    return {
        "byte": byte,
        "filter": some(WIDTH * BYTE_VECTOR, FILTERS, fan=WIDTH * BYTE_VECTOR // 4),
        "filter_bias": np.zeros(FILTERS, np.float32),
        "layer": some(FILTERS, FEATURES, fan=FILTERS // 2),
        "layer_bias": np.zeros(FEATURES, np.float32),
        "out": some(2 * FEATURES, fan=2 * FEATURES),
        "out_bias": np.zeros(1, np.float32),
    }


def chunk_starts(size: int) -> np.ndarray:
    """Where the chunks of a text of ``size`` bytes begin."""
    return np.arange(0, max(1, size - (CHUNK - STEP)), STEP)


def windows(chunks: np.ndarray, weights: Weights) -> np.ndarray:
    """What the filters read: (chunks, places, WIDTH * BYTE_VECTOR), a place every two bytes."""
    pairs = weights["byte"][chunks].reshape(len(chunks), CHUNK // 2, 2 * BYTE_VECTOR)
    places = (CHUNK - WIDTH) // 2 + 1
    return np.concatenate([pairs[:, k : k + places] for k in range(WIDTH // 2)], axis=2)


def pooled(seen: np.ndarray, weights: Weights) -> np.ndarray:
    """Answers of all filters at all places: (chunks, places, FILTERS)."""
    flat = seen.reshape(-1, seen.shape[2]) @ weights["filter"]
    return flat.reshape(seen.shape[0], seen.shape[1], -1)


def features(best: np.ndarray, weights: Weights) -> np.ndarray:
    """Features of chunks from the largest answers of their filters."""
    kept = np.maximum(best + weights["filter_bias"], 0)
    return np.maximum(kept @ weights["layer"] + weights["layer_bias"], 0)


def probability(mean: np.ndarray, most: np.ndarray, weights: Weights) -> np.ndarray:
    line = np.concatenate([mean, most], axis=1) @ weights["out"] + weights["out_bias"]
    return 1 / (1 + np.exp(-np.clip(line.astype(float), -30, 30)))


def gradients(chunks: np.ndarray, first: np.ndarray, good: np.ndarray, cost: np.ndarray, weights: Weights) -> tuple[float, Weights]:
    """Loss and gradients over documents whose chunks begin at ``first``."""
    each = np.diff(np.append(first, len(chunks)))
    doc = np.repeat(np.arange(len(first)), each)
    seen = windows(chunks, weights)
    answers = pooled(seen, weights)
    place = answers.argmax(axis=1)
    best = np.take_along_axis(answers, place[:, None, :], 1)[:, 0]
    kept = np.maximum(best + weights["filter_bias"], 0)
    own = np.maximum(kept @ weights["layer"] + weights["layer_bias"], 0)
    mean = np.add.reduceat(own, first, axis=0) / each[:, None]
    most = np.maximum.reduceat(own, first, axis=0)
    both = np.concatenate([mean, most], axis=1)
    p = probability(mean, most, weights)
    loss = -float((cost * np.where(good > 0, np.log(p + 1e-12), np.log(1 - p + 1e-12))).sum())

    slope = (cost * (p - good)).astype(np.float32)
    grad: Weights = {"out": both.T @ slope, "out_bias": np.array([slope.sum()], np.float32)}
    back = slope[:, None] * weights["out"][None, :]
    # Of equal maxima every one is moved, by its part.
    top = own == most[doc]
    ties = np.add.reduceat(top.astype(np.float32), first, axis=0)
    to_own = back[doc, :FEATURES] / each[doc][:, None].astype(np.float32) + back[doc, FEATURES:] * top / ties[doc]
    to_own *= own > 0
    grad["layer"], grad["layer_bias"] = kept.T @ to_own, to_own.sum(axis=0)
    to_best = (to_own @ weights["layer"].T) * (kept > 0)
    grad["filter_bias"] = to_best.sum(axis=0)
    read = seen[np.arange(len(chunks))[:, None], place]
    grad["filter"] = np.einsum("cfk,cf->kf", read, to_best)
    codes = chunks[np.arange(len(chunks))[:, None, None], 2 * place[:, :, None] + np.arange(WIDTH)]
    shape = weights["filter"].T.reshape(FILTERS, WIDTH, BYTE_VECTOR)
    moved = to_best[:, :, None, None] * shape[None]
    flat = codes.ravel()
    grad["byte"] = np.stack(
        [np.bincount(flat, moved[..., k].ravel(), minlength=256) for k in range(BYTE_VECTOR)], axis=1
    ).astype(np.float32)
    grad["byte"][FILLING] = 0
    return loss, grad


def one_pass(documents: list[tuple[np.ndarray, float, float]], weights: Weights, seed: int) -> Weights:
    """Weights after Adam steps over (chunks, label, cost) of every document once."""
    weights = {k: v.copy() for k, v in weights.items()}
    speed = {k: np.zeros_like(v) for k, v in weights.items()}
    spread = {k: np.zeros_like(v) for k, v in weights.items()}
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(documents))
    rate = RATE / (1 + seed / 3)
    for step, at in enumerate(range(0, len(order), DOCS_IN_STEP), 1):
        some = [documents[i] for i in order[at : at + DOCS_IN_STEP]]
        first = np.cumsum([0, *(len(d[0]) for d in some[:-1])])
        cost = np.array([d[2] for d in some]) / len(some)
        _, grad = gradients(np.concatenate([d[0] for d in some]), first, np.array([d[1] for d in some]), cost, weights)
        for k, g in grad.items():
            speed[k] = 0.9 * speed[k] + 0.1 * g
            spread[k] = 0.99 * spread[k] + 0.01 * g * g
            step_size = (speed[k] / (1 - 0.9**step)) / (np.sqrt(spread[k] / (1 - 0.99**step)) + 1e-6)
            weights[k] = (weights[k] * (1 - 1e-4) - rate * step_size).astype(np.float32)
        weights["byte"][FILLING] = 0
    return weights


def chunks_of(flat: np.ndarray, start: int, end: int, starts: np.ndarray) -> np.ndarray:
    """Chunks, from ``starts`` on, of the text in ``flat[start:end]``."""
    out = np.full((len(starts), CHUNK), FILLING, np.uint8)
    for row, at in enumerate(starts.tolist()):
        piece = flat[start + at : min(end, start + at + CHUNK)]
        out[row, : len(piece)] = piece
    return out


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a binary column, and where each row's begin and end."""
    column = pc.fill_null(column, b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    flat = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return flat, offsets[:-1], offsets[1:]


def scores(column: pa.Array, weights: Weights) -> np.ndarray:
    """Probability of every text of a binary column."""
    flat, begin, end = _bytes_of(column)
    every = [chunk_starts(b - a) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
    count = np.array([len(s) for s in every], np.int64)
    if not len(count):
        return np.zeros(0)
    doc = np.repeat(np.arange(len(count)), count)
    start = np.concatenate(every) + begin[doc]
    total = np.zeros((len(count), FEATURES), np.float64)
    most = np.zeros((len(count), FEATURES), np.float32)
    padded = np.concatenate([flat, np.full(CHUNK, FILLING, np.uint8)])
    views = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)
    for at in range(0, len(doc), AT_ONCE):
        rows = doc[at : at + AT_ONCE]
        chunks = views[start[at : at + AT_ONCE]]
        room = end[rows] - start[at : at + AT_ONCE]
        for k in np.flatnonzero(room < CHUNK).tolist():
            chunks[k, max(0, int(room[k])) :] = FILLING
        own = features(pooled(windows(chunks, weights), weights).max(axis=1), weights)
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        total[rows[first]] += np.add.reduceat(own, first, axis=0)
        most[rows[first]] = np.maximum(most[rows[first]], np.maximum.reduceat(own, first, axis=0))
    return probability((total / count[:, None]).astype(np.float32), most, weights)


@dataclass(frozen=True)
class Model:
    """Weights of the network, or one score for all texts."""

    weights: Weights | None
    share: float


def known_labels(labels: DataFrame, doc_id: str, label: str, learn: Column | None) -> DataFrame:
    """(``doc``, ``good``) of the rows that may be learnt from, one per id."""
    rows = labels if learn is None else labels.where(learn)
    known = rows.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    return known.groupBy(F.col(doc_id).alias("doc")).agg(F.min(F.col(label).cast("int")).alias("good"))


def train(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    learn: Column | None = None,
    docs: int = DOCS,
    rounds: int = ROUNDS,
) -> Model:
    """A network from labelled documents; ``learn`` says which rows of ``labels`` may be used."""
    known = known_labels(labels, doc_id, label, learn)
    counts = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    every = sum(counts.values())
    share = counts.get(1, 0) / every if every else 0.5
    if not counts.get(1) or not counts.get(0):
        return Model(None, share)
    order = F.xxhash64(F.col("doc").cast("string"), F.lit("quality"))
    halves = [known.where(F.col("good") == v).orderBy(order, "doc").limit(docs) for v in (0, 1)]
    # At most 2 x docs ids are broadcast.
    sample = cut_lineage(halves[0].unionByName(halves[1]))
    picked = documents.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").cast("binary").alias("body"))
    picked = picked.join(F.broadcast(sample), F.col("_id") == F.col("doc")).select(
        F.xxhash64(F.col("doc").cast("string"), F.lit("order")).alias("place"), "good", "body"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                flat, begin, end = _bytes_of(part.column("body"))
                out = []
                for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                    starts = chunk_starts(b - a)
                    if len(starts) > CHUNKS:
                        starts = starts[np.linspace(0, len(starts) - 1, CHUNKS).round().astype(int)]
                    out.append(chunks_of(flat, a, b, starts).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("place"), part.column("good"), pa.array(out, pa.binary())], ["place", "good", "chunks"]
                )

    examples = cut_lineage(
        picked.mapInArrow(cut, "place long, good int, chunks binary").withColumn("part", F.pmod("place", F.lit(PARTS)))
    )
    seen = {r["good"]: r["count"] for r in examples.groupBy("good").count().collect()}
    if not seen.get(1) or not seen.get(0):
        return Model(None, share)
    all_seen = sum(seen.values())
    costs = {v: (share if v else 1 - share) / (seen[v] / all_seen) for v in (0, 1)}
    weights = first_weights()
    for turn in range(rounds):

        def go_on(table: pa.Table) -> pa.Table:
            # Rows of one place may be copies or not; their bytes settle the order.
            rows = sorted(zip(*(table.column(c).to_pylist() for c in ("place", "chunks", "good")), strict=True))
            group = [(np.frombuffer(c, np.uint8).reshape(-1, CHUNK), float(g), costs[g]) for _, c, g in rows]
            new = one_pass(group, weights, turn)  # noqa: B023
            return pa.table(
                {
                    "part": table.column("part")[:1],
                    "n": pa.array([len(rows)], pa.int64()),
                    "weights": pa.array([pickle.dumps(new)], pa.binary()),
                }
            )

        done = examples.groupBy("part").applyInArrow(go_on, "part long, n long, weights binary").collect()
        done = sorted(done, key=lambda r: r["part"])
        size = sum(r["n"] for r in done)
        parts = [(r["n"] / size, pickle.loads(r["weights"])) for r in done]
        weights = {k: sum(n * w[k] for n, w in parts).astype(np.float32) for k in weights}
    return Model(weights, share)


def score(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ``score``) of every row."""
    source = documents.select(F.col(doc_id).alias("id"), F.col(text).cast("string").cast("binary").alias("body"))
    if model.weights is None:
        return source.select(F.col("id").alias(doc_id), F.lit(model.share).alias("score"))
    kind, weights = source.schema["id"].dataType.simpleString(), model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                found = pa.array(scores(part.column("body"), weights))
                yield pa.RecordBatch.from_arrays([part.column("id"), found], ["id", "score"])

    return source.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", doc_id)
