import hashlib
import random
import re

from siftwell.llm import winnowing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    doc = words(text)
    hit, found = set(), set()
    for item, body in items:
        own = words(body)
        n = min(10, len(own))
        wins = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(doc) - n + 1):
            if n and tuple(doc[i : i + n]) in wins:
                hit.update(range(i, i + n))
                found.add("" if item is None else str(item))
    ids = ",".join(sorted(found))
    return len(doc), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def test_counts_match_brute_force(spark, docs):
    rng = random.Random(3)
    vocab = ["a", "b", "c", "dé", "E1", "ßx", "9"]
    line = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, line(n)) for i, n in enumerate([0, 1, 3, 3, 9, 10, 11, 25, 40])]
    items += [(20, items[7][1]), (20, items[8][1]), (None, items[6][1]), (30, None), (31, "the the the the the the the the the the the")]
    rows = [(i, line(rng.randrange(0, 60))) for i in range(40)]
    rows += [(100 + i, f"{line(4)}, {b}! {line(4)}") for i, (_, b) in enumerate(items) if b]
    rows += [(200, None), (201, ""), (202, "..."), (203, "the " * 40), (100, rows[0][1]), (100, rows[0][1]), (None, items[7][1])]
    rows += [(300, line(30_000) + " " + items[8][1])]
    bench = spark.createDataFrame(items, "item_id int, text string")
    want = sorted([(i, *brute(t, items)) for i, t in rows], key=str)
    for limit in (winnowing.BROADCAST_BYTES, 0):
        got = winnowing.digest(winnowing.contaminated(docs(rows), bench, broadcast_bytes=limit))
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id int, text string")
    rows = winnowing.digest(winnowing.contaminated(docs([(1, "a b")]), bench)).collect()
    assert [tuple(r)[:4] for r in rows] == [(1, 2, 0, 0)]
    assert winnowing.contaminated(docs([]), bench).count() == 0


def test_clean_documents_stay(spark, docs):
    passage = " ".join(f"w{i}" for i in range(12))
    bench = spark.createDataFrame([(1, passage)], "item_id int, text string")
    frame = docs([(1, f"x {passage} y"), (2, "x y"), (3, None), (None, "z")])
    left = winnowing.without_passages(frame, bench)
    assert left.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["2", "3", "None"]
