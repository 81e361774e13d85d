"""Greedy longest-match token counts by one linear automaton.

A word is split into pieces by always taking the longest vocabulary entry that the rest begins
with. The vocabulary is a trie. A node that is no entry has a failure link: the node that is
reached after the longest pieces are taken off the front of its string, and the number of pieces
taken; both are worked out beforehand, level by level. Reading a word then costs one step per
symbol and one per piece, nothing is read twice, and no piece is ever built.

The words of a batch are read together, one column of symbols after the other, and every task
remembers the counts of at most ``CACHE`` distinct words.

The text is cut at white space; every stretch gets a blank in front, by which byte-level
vocabularies mark the start of a word, and is cut into words: runs of letters, of digits and of
other signs. A word that cannot be split whole counts as one unknown token; none can be with a
vocabulary that holds every single byte.

Cases: null and empty texts have no words and no tokens. Repeated rows stay. Other columns are
ignored. The vocabulary is a file that every executor can read, or a table of entries shipped with
the job.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.batches import pieces as small
from siftwell.llm.packing import byte_letters

CACHE = 400_000
WORD = re.compile(r" ?(?:[^\W\d_]+|\d+|(?:[^\w\s]|_)+)")


def read_vocabulary(path: str) -> list[bytes]:
    """Entries of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special = {t["content"] for t in model["added_tokens"]}
    letters = byte_letters()
    return [bytes(letters[c] for c in t) for t in model["model"]["vocab"] if t not in special]


class Automaton:
    """Byte trie with failure links."""

    def __init__(self, entries: list[bytes]):
        children: list[dict[int, int]] = [{}]
        is_entry = [False]
        parent, symbol = [0], [0]
        for entry in entries:
            at = 0
            for s in entry:
                below = children[at].get(s)
                if below is None:
                    below = children[at][s] = len(children)
                    children.append({})
                    is_entry.append(False)
                    parent.append(at)
                    symbol.append(s)
                at = below
            if at:
                is_entry[at] = True
        n = len(children)
        # The node after a failure, -1 if the rest cannot be split; and the pieces taken on the way.
        link, popped = [-1] * n, [0] * n
        level = sorted(children[0].values())
        while level:
            following: list[int] = []
            for v in level:
                following.extend(children[v].values())
                if is_entry[v]:
                    link[v], popped[v] = 0, 1
                    continue
                u, s = parent[v], symbol[v]
                at, taken = link[u], popped[u]
                while at >= 0 and s not in children[at]:
                    taken += popped[at]
                    at = link[at]
                if at >= 0:
                    link[v], popped[v] = children[at][s], taken
            level = following
        self.link, self.popped = np.array(link), np.array(popped)
        edges = sorted((u * 256 + s, v) for u, row in enumerate(children) for s, v in row.items())
        self.keys = np.array([k for k, _ in edges], np.int64)
        self.to = np.array([v for _, v in edges], np.int64)

    def _step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Child by symbol, -1 if there is none."""
        if not len(self.keys):
            return np.full(len(node), -1)
        want = node * 256 + symbol
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.to[at], -1)

    def _fail(self, node, total, rows) -> np.ndarray:
        """Take the pieces of nodes ``rows`` off; rows that cannot be split are returned as dead."""
        total[rows] += self.popped[node[rows]]
        node[rows] = self.link[node[rows]]
        return rows[node[rows] < 0]

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each word; -1 where it cannot be split."""
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        lengths = np.array([len(words[i]) for i in order], np.int64)
        n = len(words)
        flat = np.frombuffer(b"".join(words[i] for i in order), np.uint8)
        starts = np.cumsum(lengths) - lengths
        node, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        dead = np.zeros(n, bool)
        active = n
        for at in range(int(lengths.max(initial=0))):
            # Longer words come first, so the words still being read are a prefix.
            active = int(np.searchsorted(-lengths[:active], -at, side="left"))
            symbol = flat[starts[:active] + at].astype(np.int64)
            rows = np.flatnonzero(~dead[:active])
            while len(rows):
                below = self._step(node[rows], symbol[rows])
                moved = below >= 0
                node[rows[moved]] = below[moved]
                rows = rows[~moved]
                gone = self._fail(node, total, rows)
                dead[gone] = True
                rows = rows[node[rows] >= 0]
        rows = np.flatnonzero(~dead & (node > 0))
        while len(rows):
            gone = self._fail(node, total, rows)
            dead[gone] = True
            rows = rows[node[rows] > 0]
        out = np.empty(n, np.int64)
        out[order] = np.where(dead, -1, total)
        return out


def words_of(stretch: str) -> list[bytes]:
    return [w.encode("utf-8", "surrogatepass") for w in WORD.findall(" " + stretch)]


def count_tokens(
    documents: DataFrame, entries: list[bytes], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, ``n_words``, ``n_tokens``, ``n_unknown``) for every row; unknown words are tokens too."""
    source = documents.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text"))
    kind = source.schema["doc"].dataType.simpleString()
    # The vocabulary has a fixed size; it is sent to each executor once.
    shared = documents.sparkSession.sparkContext.broadcast(entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(shared.value)
        known: dict[str, tuple[int, int, int]] = {}
        for batch in chain.from_iterable(map(small, batches)):
            texts = [(t.as_py() or "").split() for t in batch.column(1)]
            if len(known) > CACHE:
                known.clear()
            new = list(set().union(*texts).difference(known))
            parts = [words_of(c) for c in new]
            distinct = list({w for p in parts for w in p})
            pieces = dict(zip(distinct, automaton.counts(distinct).tolist(), strict=True))
            for chunk, part in zip(new, parts, strict=True):
                found = [pieces[w] for w in part]
                lost = found.count(-1)
                known[chunk] = (len(part), sum(found) + 2 * lost, lost)
            sums = [tuple(map(sum, zip(*map(known.__getitem__, t), strict=True))) or (0, 0, 0) for t in texts]
            columns = [pa.array(c, pa.int64()) for c in zip(*sums, strict=True)] if sums else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["doc", "n_words", "n_tokens", "n_unknown"]
            )

    counted = source.mapInArrow(run, f"doc {kind}, n_words long, n_tokens long, n_unknown long")
    return counted.withColumnRenamed("doc", doc_id)
