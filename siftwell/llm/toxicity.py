"""Toxicity scores from a string-kernel support vector machine.

The kernel counts common subsequences of ``ORDER`` characters, each weighted by ``DECAY`` to the
length it spans in both strings, and is normalised to 1 for equal strings; so a letter put into an
insult, or left out, lowers the value without making it zero. The kernel space is spanned by
Nystroem landmarks, a linear SVM is trained in it, and a text scores by its most toxic spans.

A span is a word, lower-cased and without signs at its ends; words over ``SPAN`` characters are
read in overlapping pieces. A word with signs inside is also read without them, and three or more
single characters in a row also as one span ("i d i o t"). A sentence is what stands between end marks or line breaks.

Training looks at labelled sentences: a sentence carries the label of its document; one that several
documents hold belongs to the first of them and has the label of most (so copies of a wrongly
labelled document weigh no more than it does). A span counts once per document, however often a
long one repeats it, and is a positive example when at least ``EVIDENCE`` toxic documents hold it and
their share is beyond chance (a log-likelihood ratio that grows with the number of spans tested). Negatives are the commonest spans of clean sentences and a
hashed sample of the rest, and spans that toxic documents hold more often than others do but clean ones too.
Logistic curves over the largest margin and over the ``HINTS`` largest ones, of different spans, turn
margins into scores: a word that looks like an insult by chance is mostly alone.

Bounds: training reads at most ``DOCS`` documents of each label, chosen by a hash of the id; the
driver gets at most ``SPANS`` spans and 2 x ``DOCS`` times ``HINTS`` margins. At most ``POSITIVES`` positive spans,
those with the largest ratios, and ``DOUBTFUL`` doubtful ones are learnt; every one of them that the landmarks do not span already
becomes a landmark, beside ``CLEAN_LANDMARKS`` negative ones. A span's cost follows its own
subsequences, not the number of landmarks. Scoring reads every text whole, and
shuffles nothing. A task scores a distinct span once and keeps at most ``CACHE`` of them.

Cases: null and empty texts have no span and get the score of a text without any hint. Labels that
are null are ignored; a document with several labels is toxic if one says so. Without examples of
both kinds, or without a positive span, every score is the share of toxic training documents.
Repeated rows stay. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import chain, combinations
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.batches import hand_back
from siftwell.llm.batches import pieces as small
from siftwell.runtime import cut_lineage

ORDER = 3
DECAY = 0.8
SPAN = 24
DOCS = 4000
SPANS = 20_000
POSITIVES = 1000
# Documents that must hold a span for it to be positive, and the part of all that hold it that must
# be toxic; of the others that are still more frequent there, so many are learnt as negatives.
EVIDENCE = 4
RELIABLE = 0.7
DOUBTFUL = 200
NEGATIVES_FIRST = 1000
NEGATIVES_MORE = 500
ROUNDS = 5
CLEAN_LANDMARKS = 8
# A positive whose squared distance from the span of the landmarks is larger becomes one itself.
RESIDUAL = 0.05
MARKS_AT_ONCE = 64
# Margins of a document that its score is made of.
HINTS = 3
# Subsequences looked up at a time.
TERMS = 1_000_000
CACHE = 400_000
BATCH = 512
THRESHOLD = 0.3

_SINGLES = re.compile(r"(?<!\S)\S(?:\s\S){2,}(?!\S)")
_ENDS = re.compile(r"^[\W_]+|[\W_]+$")
_SIGNS = re.compile(r"[\W_]+")
_SENTENCE = r"[.!?\n]+"


def span_of(word: str) -> str:
    """A word as a span: lower case, without signs at the ends."""
    word = word.lower()
    if word.isalnum():
        return word
    return _ENDS.sub("", word)


def pieces(span: str) -> list[str]:
    """Overlapping pieces of at most SPAN characters."""
    if len(span) <= SPAN:
        return [span] if span else []
    return [span[i : i + SPAN] for i in range(0, len(span) - SPAN // 2, SPAN // 2)]


def spelled(text: str) -> list[str]:
    """Runs of single characters, joined."""
    return [p for m in _SINGLES.findall(text) for p in pieces("".join(m.split()).lower())]


def _codes(spans: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in spans], np.int64)
    out = np.full((len(spans), max(1, int(lengths.max(initial=1)))), -1, np.int32)
    for i, s in enumerate(spans):
        out[i, : len(s)] = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.int32)
    return out, lengths


def subsequence_kernel(a: np.ndarray, b: np.ndarray, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """Kernel of every row of ``a`` (n, la) with every row of ``b`` (n or 1, m, lb); codes, -1 pads.

    Characters are read one by one; ``prefix[i][j]`` holds the weight of common subsequences of
    length i in what was read and in the first j characters of b, decayed up to the end of both.
    """
    n, m, lb = a.shape[0], b.shape[1], b.shape[2]
    prefix = [[np.ones((n, m), np.float32) if i == 0 else np.zeros((n, m), np.float32) for _ in range(lb + 1)] for i in range(order)]
    total = np.zeros((n, m), np.float32)
    square = np.float32(decay * decay)
    decay = np.float32(decay)
    for at in range(a.shape[1]):
        c = a[:, at][:, None]
        same = [((c == b[:, :, j]) & (c >= 0)).astype(np.float32) * square for j in range(lb)]
        for j in range(lb):
            total += same[j] * prefix[order - 1][j]
        for i in range(order - 1, 0, -1):
            run = np.zeros((n, m), np.float32)
            for j in range(lb):
                run = run * decay + same[j] * prefix[i - 1][j]
                prefix[i][j + 1] = prefix[i][j + 1] * decay + run
    return total


def normalised(spans: list[str], marks: list[str]) -> np.ndarray:
    """Normalised kernel of spans with landmarks; 0 where a string is shorter than the order."""
    a, la = _codes(spans)
    b, lb = _codes(marks)
    own_b = subsequence_kernel(b, b[:, None, :])[:, 0]
    out = np.zeros((len(spans), len(marks)), np.float32)
    order = np.argsort(la, kind="stable")
    for at in range(0, len(spans), BATCH):
        rows = order[at : at + BATCH]
        part = a[rows, : max(1, int(la[rows].max()))]
        own = subsequence_kernel(part, part[:, None, :])[:, 0]
        both = [subsequence_kernel(part, b[None, m : m + MARKS_AT_ONCE]) for m in range(0, len(b), MARKS_AT_ONCE)]
        both = np.concatenate(both, axis=1)
        scale = np.sqrt(own[:, None] * own_b[None, :])
        out[rows] = np.divide(both, scale, out=np.zeros_like(both), where=scale > 0)
    return out


def landmarks(spans: list[str]) -> list[str]:
    """Spans, each the farthest from those before, until all lie near the space they open up."""
    gram = normalised(spans, spans).astype(float)
    rest, rows, picked = gram.diagonal().copy(), np.zeros((0, len(spans))), []
    while rest.max() > RESIDUAL:
        at = int(rest.argmax())
        row = (gram[at] - rows[:, at] @ rows) / np.sqrt(rest[at])
        rows = np.vstack([rows, row])
        rest -= row * row
        rest[at] = 0
        picked.append(spans[at])
    return picked


@dataclass(frozen=True)
class Subsequences:
    """A decision function in the kernel space, as one weight per subsequence of ``ORDER`` characters.

    The kernel is an inner product over subsequences, so the sum of weighted kernels with all
    landmarks is a sum over the subsequences of the span alone, whatever the number of landmarks.
    """

    letters: np.ndarray
    weight: np.ndarray

    @staticmethod
    def of(marks: tuple[str, ...], weights: tuple[float, ...]) -> Subsequences:
        codes, lengths = _codes(list(marks))
        letters = np.unique(codes[codes >= 0])
        size = len(letters) + 1
        own = np.sqrt(subsequence_kernel(codes, codes[:, None, :])[:, 0].astype(float))
        weight = np.zeros(size**ORDER)
        for code, n, scale, w in zip(codes, lengths.tolist(), own.tolist(), weights, strict=True):
            if scale:
                at, spread = _places(n)
                number = np.searchsorted(letters, code[:n]) + 1
                np.add.at(weight, _numbers(number[None, :], at, size)[0], w / scale * spread)
        return Subsequences(letters, weight.astype(np.float32))

    def sums(self, spans: list[str]) -> np.ndarray:
        """Weighted kernels with all landmarks, normalised; 0 for spans shorter than the order."""
        codes, lengths = _codes(spans)
        size = len(self.letters) + 1
        near = np.minimum(np.searchsorted(self.letters, codes), size - 2)
        number = np.where(self.letters[near] == codes, near + 1, 0).astype(np.int32)
        out = np.zeros(len(spans), np.float32)
        for n in np.unique(lengths[lengths >= ORDER]).tolist():
            at, spread = _places(n)
            rows = np.flatnonzero(lengths == n)
            for some in np.array_split(rows, -(-len(rows) * len(spread) // TERMS)):
                total = self.weight[_numbers(number[some, :n], at, size)] @ spread
                part = codes[some, :n]
                out[some] = total / np.sqrt(subsequence_kernel(part, part[:, None, :])[:, 0])
        return out


def _places(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all subsequences in n characters, (ORDER, count), and their weights."""
    at = np.array(list(combinations(range(n), ORDER)), np.intp).reshape(-1, ORDER).T
    return at, (DECAY ** (at[-1] - at[0] + 1)).astype(np.float32)


def _numbers(letters: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Number of every subsequence of every row of ``letters``."""
    out = letters[:, at[0]]
    for place in at[1:]:
        out = out * size + letters[:, place]
    return out


@dataclass(frozen=True)
class Model:
    """Landmarks, their weights in the decision function, and logistic curves over a document's
    ``HINTS`` largest margins, of different spans: slopes and an offset each. A score is their mean."""

    marks: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float
    curves: tuple[tuple[float, ...], ...]

    @cached_property
    def subsequences(self) -> Subsequences:
        return Subsequences.of(self.marks, self.weights)

    def margins(self, spans: list[str]) -> np.ndarray:
        return self.subsequences.sums(spans) + np.float32(self.bias)

    def score(self, hints: np.ndarray) -> np.ndarray:
        hints = np.clip(hints, NO_HINT, -NO_HINT)
        lines = [hints @ np.array(curve[:-1]) + curve[-1] for curve in self.curves]
        return np.mean([1 / (1 + np.exp(-np.clip(line, -30, 30))) for line in lines], axis=0)


NO_HINT = -2.0


def best_margins(texts: list[str | None], model: Model, known: dict[str, float]) -> np.ndarray:
    """The ``HINTS`` largest margins of different spans of each text, at least NO_HINT, falling."""
    spans = []
    for text in texts:
        text = text or ""
        found = set()
        for word in set(text.split()):
            span = span_of(word)
            if len(span) >= ORDER:
                found.update((span,) if len(span) <= SPAN else pieces(span))
                if not span.isalnum():
                    found.update(pieces(_SIGNS.sub("", span)))
        found.update(spelled(text))
        spans.append(found)
    if len(known) > CACHE:
        known.clear()
    new = sorted(set().union(*spans).difference(known)) if spans else []
    for at in range(0, len(new), 64 * BATCH):
        part = new[at : at + 64 * BATCH]
        known.update(zip(part, model.margins(part).tolist(), strict=True))
    out = np.full((len(texts), HINTS), NO_HINT)
    for i, found in enumerate(spans):
        values = np.fromiter(map(known.__getitem__, found), float, len(found))
        best = np.sort(np.partition(values, -HINTS)[-HINTS:] if len(values) > HINTS else values)[::-1]
        out[i, : len(best)] = np.maximum(best, NO_HINT)
    return out


_HINTS = "margin double, second double, third double"


def margins(documents: DataFrame, model: Model, doc_id: str, text: str) -> DataFrame:
    """(``doc``, ``margin``, ``second``, ``third``) for every row: its largest margins."""
    source = documents.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text"))
    kind = source.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in chain.from_iterable(map(small, batches)):
            found = best_margins(batch.column(1).to_pylist(), model, known)
            columns = [pa.array(np.ascontiguousarray(c)) for c in found.T]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc", "margin", "second", "third"])
        known.clear()
        hand_back()

    return source.mapInArrow(run, f"doc {kind}, {_HINTS}")


def _train_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Linear SVM with weighted hinge loss by dual coordinate descent; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    norm = (x * x).sum(1)
    rng = np.random.default_rng(0)
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            new = min(max(alpha[i] - (y[i] * (x[i] @ w) - 1) / norm[i], 0.0), cost[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Slopes (of every column of ``x``) and offset of a weighted logistic curve, by damped Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + 1e-3 * w
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(a.shape[1])
        step = np.linalg.solve(hess, grad)
        w -= step / max(1.0, float(np.abs(step).max()) / 4)
    return tuple(w.tolist())


def sentence_spans(documents: DataFrame) -> DataFrame:
    """(``toxic``, ``owner``, ``span``), each once, of labelled documents (``doc``, ``toxic``, ``text``).

    A sentence that several documents hold, as near copies do, belongs to the one with the smallest
    id and is toxic if at least half of them are.
    """
    sentences = documents.select("doc", "toxic", F.explode(F.split("text", _SENTENCE)).alias("sentence"))
    sentences = sentences.groupBy(F.lower(F.trim("sentence")).alias("sentence")).agg(
        (F.avg("toxic") >= 0.5).cast("int").alias("toxic"), F.min("doc").alias("owner")
    )
    words = F.array_distinct(F.transform(F.split("sentence", r"\s+"), lambda w: F.regexp_replace(w, r"^[\W_]+|[\W_]+$", "")))
    spans = sentences.select("toxic", "owner", F.explode(words).alias("span"))
    return spans.where(F.length("span").between(ORDER, SPAN) & F.col("span").rlike(r"^\w")).distinct()


def known_labels(labels: DataFrame, doc_id: str, label: str, learn: Column | None) -> DataFrame:
    """(``doc``, ``toxic``) of the rows that may be learnt from, one per id."""
    rows = labels if learn is None else labels.where(learn)
    known = rows.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    return known.groupBy(F.col(doc_id).alias("doc")).agg(F.max(F.col(label).cast("int")).alias("toxic"))


def chosen(known: DataFrame, docs: int) -> DataFrame:
    """At most ``docs`` rows of each label, by a hash of the id."""
    order = F.xxhash64(F.col("doc").cast("string"), F.lit("toxicity"))
    parts = [known.where(F.col("toxic") == v).orderBy(order, "doc").limit(docs) for v in (0, 1)]
    return parts[0].unionByName(parts[1])


def train(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    learn: Column | None = None,
    docs: int = DOCS,
) -> Model:
    """A model from labelled documents; ``learn`` says which rows of ``labels`` may be used."""
    known = known_labels(labels, doc_id, label, learn)
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    prior = sizes.get(1, 0) / max(1, sum(sizes.values()))
    flat = Model((), (), 0.0, (((0.0,) * HINTS + (float(np.log(max(prior, 1e-3) / max(1 - prior, 1e-3))),)),))
    if not sizes.get(1) or not sizes.get(0):
        return flat
    sample = cut_lineage(chosen(known, docs))
    # At most 2 x docs ids are broadcast; their texts are read once.
    picked = documents.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("text"))
    picked = picked.join(F.broadcast(sample), F.col("_id") == F.col("doc")).select("doc", "toxic", "text")
    picked = cut_lineage(picked)
    spans = sentence_spans(picked)
    counted = spans.groupBy("span").agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0"))
    # Spans that few documents hold are not tested.
    total = counted.agg(F.count_if(F.col("n1") + F.col("n0") >= EVIDENCE), F.sum("n1"), F.sum("n0")).first()
    if not total[0] or not total[1] or not total[2]:
        return flat
    base = total[1] / (total[1] + total[2])
    n = F.col("n1") + F.col("n0")
    part = lambda c, p: F.when(c > 0, c * F.log(c / (n * F.lit(p)))).otherwise(F.lit(0.0))
    ratio = 2 * (part(F.col("n1"), base) + part(F.col("n0"), 1 - base))
    beyond = 2 * float(np.log(total[0])) + 2
    # Shares as in all labels, whatever part of each was sampled.
    taken = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    real = [sizes[v] / taken[v] for v in (0, 1)]
    share = F.col("n1") * real[1] / (F.col("n1") * real[1] + F.col("n0") * real[0])
    often = (F.col("n1") >= EVIDENCE) & (F.col("n1") / n > base) & (ratio > beyond)
    toxic = counted.where(often & (share >= RELIABLE))
    positives = [r["span"] for r in toxic.orderBy(F.desc(ratio), "span").limit(POSITIVES).collect()]
    doubtful = counted.where(often & (share < RELIABLE)).orderBy(F.desc("n0"), "span").limit(DOUBTFUL)
    doubtful = [r["span"] for r in doubtful.collect()]
    if not positives:
        return flat
    clean = counted.where((F.col("n0") > F.col("n1")) & (ratio < beyond))
    half = (SPANS - POSITIVES) // 2
    common = clean.orderBy(F.desc("n0"), "span").limit(half)
    others = clean.orderBy(F.xxhash64("span"), "span").limit(half)
    negatives = sorted({r["span"] for r in common.unionByName(others).collect()} - set(positives) - set(doubtful))
    if not negatives:
        return flat

    some = CLEAN_LANDMARKS
    marks = landmarks(positives + doubtful) + negatives[:: max(1, len(negatives) // some)][:some]
    negatives = doubtful + negatives
    gram = normalised(marks, marks).astype(float)
    value, vector = np.linalg.eigh(gram)
    keep = value > 1e-4
    whiten = vector[:, keep] / np.sqrt(value[keep])
    pool = normalised(negatives, marks).astype(float) @ whiten
    bad = normalised(positives, marks).astype(float) @ whiten
    used = np.zeros(len(negatives), bool)
    used[:: max(1, len(negatives) // NEGATIVES_FIRST)] = True
    used[: len(doubtful)] = True
    for _ in range(ROUNDS):
        good = pool[used]
        y = np.r_[np.ones(len(bad)), -np.ones(len(good))]
        cost = np.where(y > 0, 10.0 * len(good) / len(bad), 10.0)
        w = _train_svm(np.vstack([bad, good]), y, cost)
        wrong = np.where(used, -np.inf, pool @ w[:-1] + w[-1])
        worst = np.argsort(-wrong, kind="stable")[:NEGATIVES_MORE]
        worst = worst[wrong[worst] > -1]
        if not len(worst):
            break
        used[worst] = True
    fitted = Model(tuple(marks), tuple((whiten @ w[:-1]).tolist()), float(w[-1]), ())

    # A few numbers per sampled document.
    found = margins(picked.select("doc", "text"), fitted, "doc", "text").join(F.broadcast(sample), "doc")
    rows = found.select("margin", "second", "third", "toxic").collect()
    y = np.array([float(r["toxic"]) for r in rows])
    weight = np.where(y > 0, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    hints = np.clip([[r["margin"], r["second"], r["third"]] for r in rows], NO_HINT, -NO_HINT)
    # Half of a score asks for one toxic span, half for several.
    slope, offset = _logistic(hints[:, 0], y, weight)
    curves = ((slope, *(0.0,) * (HINTS - 1), offset), _logistic(hints, y, weight))
    return Model(fitted.marks, fitted.weights, fitted.bias, curves)


def score(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ``margin``, ``score``) for every row."""
    nothing = [F.lit(NO_HINT).alias(c) for c in ("margin", "second", "third")]
    found = margins(documents, model, doc_id, text) if model.marks else documents.select(F.col(doc_id).alias("doc"), *nothing)

    def along(curve: tuple[float, ...]) -> Column:
        line = F.lit(curve[-1])
        for name, slope in zip(("margin", "second", "third"), curve, strict=False):
            line = line + slope * F.greatest(F.lit(NO_HINT), F.least(F.lit(-NO_HINT), F.col(name)))
        return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), line))))

    mean = reduce(add, map(along, model.curves)) / len(model.curves)
    return found.select(F.col("doc").alias(doc_id), "margin", mean.alias("score"))


def accepted(
    documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Documents that score below the threshold, with their columns."""
    if not model.marks:
        return documents
    columns = documents.columns
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in chain.from_iterable(map(small, batches)):
            found = model.score(best_margins(batch.column(at).to_pylist(), model, known))
            yield batch.filter(pa.array(found < threshold))
        known.clear()
        hand_back()

    return documents.mapInArrow(run, documents.schema)
