import collections

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from siftwell.llm import packing

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ENCODE = packing.text_encoder(VOCABULARY, public_tokenizers.PATTERN)
TOKENIZER = Tokenizer.from_file(VOCABULARY)


def ids(text):
    return list(np.frombuffer(ENCODE(text), "<u4"))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab Z\n\t.,'s9é中\u00a0\u2003\x1c\x85<|>end")), max_size=40))
def test_ids_are_those_of_the_tokenizer(text):
    assert ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", " ", "  a", "a  b", "a <|endoftext|> b", "x<|endoftext|>", "it's  \n\n we'll", " lead", "trail "])
def test_ids_of_hard_texts(text):
    assert ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def brute_level(counts, window, size):
    """Level by trying every placement and summing the squares."""
    best = None
    for level in range(window - size, -1, -1):
        if level and not counts[level]:
            continue
        after = collections.Counter({k: v for k, v in enumerate(counts) if v})
        if level:
            after[level] -= 1
        if level + size < window:
            after[level + size] += 1
        cost = sum(v * v for v in after.values())
        if best is None or cost < best[0]:
            best = (cost, level)
    return best[1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.integers(1, 12))
def test_placement_and_windows(sizes, max_open):
    windows = []
    packer = packing.SumOfSquares(16, lambda pieces: windows.append(list(pieces)), max_open)
    for doc, n in enumerate(sizes):
        rest = n % 16
        if rest:
            before = packer.counts[:16].tolist()
            assert packer.level_for(rest) == brute_level(before, 16, rest)
        packer.add(doc, np.arange(n, dtype=np.uint32))
    packer.close()
    seen = collections.defaultdict(list)
    for pieces in windows:
        length = sum(len(p.ids) for p in pieces)
        assert length == 16 or length & (length - 1) == 0
        for p in pieces:
            assert p.total == sizes[p.doc]
            assert p.ids.tolist() == list(range(p.start, p.start + len(p.ids)))
            seen[p.doc] += p.ids.tolist()
    assert {d: sorted(x) for d, x in seen.items()} == {d: list(range(n)) for d, n in enumerate(sizes)}


def test_pack_table(spark, docs):
    rows = [(1, "a b c " * 3000), (2, None), (3, ""), (4, "x"), (4, "x"), (None, "hello there"), (5, "wörd " * 10)]
    got = packing.pack(docs(rows).repartition(3), VOCABULARY, public_tokenizers.PATTERN).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append(r)
    for pieces in by.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == np.cumsum([0] + [r["length"] for r in pieces[:-1]]).tolist()
    tokens = collections.Counter()
    for r in got:
        assert len(r["ids"]) == 4 * r["length"]
        tokens[r["doc_id"]] += r["length"]
    want = collections.Counter()
    for i, t in rows:
        want[i] += len(TOKENIZER.encode(t or "", add_special_tokens=False).ids) + 1
    assert tokens == want
    assert packing.pack(docs([]), VOCABULARY, public_tokenizers.PATTERN).count() == 0
