"""Runs against brute force: every period, every stretch, word by word."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siftwell.llm import repeats


def slow_runs(words, shortest=12):
    """All maximal stretches of every period, smallest period per place."""
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= shortest:
                best.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in best.items())


def fast_runs(words, shortest=12):
    return [tuple(r) for r in repeats.runs_of(np.array(words, np.int64), shortest).tolist()]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


@pytest.mark.parametrize("shortest", [1, 12])
def test_known_sequences(shortest):
    for words in ([], [1], [1, 1], [5] * 300, [1, 2] * 90, [1, 2, 3] * 40 + [9] + [1, 2, 3] * 40, fibonacci(400), morse(512)):
        assert fast_runs(words, shortest) == slow_runs(words, shortest)


def test_random_sequences():
    rng = random.Random(1)
    for _ in range(300):
        n, k = rng.randrange(1, 160), rng.choice([1, 2, 2, 3, 5])
        words = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randrange(3)):
            a = rng.randrange(n)
            p = rng.randrange(1, 30)
            words[a:a] = (words[a : a + p] or [0]) * rng.randrange(1, 6)
        shortest = rng.choice([1, 6, 12])
        assert fast_runs(words, shortest) == slow_runs(words, shortest)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=9), st.integers(1, 6)), max_size=8))
def test_repeated_blocks(blocks):
    words = [w for b, n in blocks for w in b * n]
    assert fast_runs(words) == slow_runs(words)


def test_appended_word_by_word():
    """Squares are reported with the word that completes them, and the runs are the same."""
    rng = random.Random(2)
    for _ in range(40):
        words = [rng.randrange(2) for _ in range(60)]
        words[20:20] = words[3:12] * 3
        one = repeats.Catchers(shortest=1)
        told = set()
        for i, w in enumerate(words):
            for start, period in one.append([w]).tolist():
                assert start + 2 * period == i + 1
                told.add((start, period))
        assert {(s, q) for s, _, q in slow_runs(words, 1)} <= told
        assert [tuple(r) for r in one.runs().tolist()] == slow_runs(words, 1)


def test_appended_in_pieces():
    rng = random.Random(3)
    for _ in range(40):
        words = [rng.randrange(3) for _ in range(200)]
        words[50:50] = words[10:45] * 3 + [1] * 40
        piecewise, at = repeats.Catchers(), 0
        while at < len(words):
            step = rng.randrange(1, 50)
            piecewise.append(words[at : at + step])
            at += step
        assert [tuple(r) for r in piecewise.runs().tolist()] == slow_runs(words)


def test_equal_hashes_start_again(monkeypatch):
    words = [1, 2, 3, 4] * 9
    # With base 1 a hash is the sum of the words, so all orders look alike.
    monkeypatch.setattr(repeats, "BASES", (1, *repeats.BASES))
    scrambled = words + [2, 1, 4, 3] * 9 + [4, 3, 2, 1] * 5
    assert fast_runs(scrambled) == slow_runs(scrambled)


def slow_row(doc_id, text):
    import re

    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = slow_runs(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    longest = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (
        doc_id, len(runs), *longest,
        sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query_rows(docs, run, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP", 500)
    rng = random.Random(4)
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "a " * 40), (5, "x y  \x1cz " * 7), (5, "x " * 7), (5, "x " * 7)]
    rows += [(i, " ".join(rng.choice("ab") + rng.choice(["", "c"]) for _ in range(rng.randrange(1, 90)))) for i in range(10, 90)]
    rows += [(100, "lorem ipsum dolor " * 700)]
    got = run(repeats.digest(repeats.find_runs(docs(rows), rewrite=repeats.echoing)))
    assert sorted(got, key=repr) == sorted((slow_row(*r) for r in rows), key=repr)
    assert sum(r[1] > 0 for r in got) > 5


def test_empty_table(docs, run):
    assert run(repeats.digest(repeats.find_runs(docs([]), rewrite=repeats.echoing))) == []
