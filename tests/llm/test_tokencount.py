import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from siftwell.llm import tokencount

ENTRIES = [b"a", b"b", b"c", b"ab", b"abc", b"bcab", b"cabab", b"aaaa", b"abcabx", " é".encode(), b" a", b" ab"]


def greedy(word, entries):
    n = 0
    while word:
        k = next((k for k in range(len(word), 0, -1) if word[:k] in entries), 0)
        if not k:
            return -1
        word, n = word[k:], n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abcxé ", max_size=14), max_size=8))
def test_automaton_is_greedy_longest_match(words):
    words = [w.encode() for w in words]
    automaton = tokencount.Automaton(ENTRIES)
    assert automaton.counts(words).tolist() == [greedy(w, set(ENTRIES)) for w in words]


def test_empty_vocabulary():
    assert tokencount.Automaton([]).counts([b"a", b""]).tolist() == [-1, 0]


def test_counts_of_documents(spark, docs):
    entries = tokencount.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    known = set(entries)
    rows = [(1, "Hello world, it's 2024!"), (2, None), (3, ""), (4, " \n\t "), (5, "x" * 5000), (5, "x" * 5000), (None, "ñandú\n中文 a_b")]
    want = []
    for i, t in rows:
        words = [w for c in (t or "").split() for w in tokencount.words_of(c)]
        assert b"".join(words) == b"".join(b" " + c.encode() for c in (t or "").split())
        want.append((i, len(words), sum(greedy(w, known) for w in words), 0))
    got = tokencount.count_tokens(docs(rows), entries).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    few = [tuple(r) for r in tokencount.count_tokens(docs([(1, "ab zz ab")]), [b" ab"]).collect()]
    assert few == [(1, 3, 3, 1)]
    assert tokencount.count_tokens(docs([]), entries).count() == 0
