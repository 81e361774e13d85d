import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siftwell.llm import components, simhash


def fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(n, linked):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if linked(i, j) and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


@pytest.mark.parametrize("seed", range(6))
def test_trie_groups_match_all_pairs(seed):
    rng = np.random.default_rng(seed)
    keys = rng.integers(0, 1 << 20, 60, np.uint64) << np.uint64(rng.integers(0, 40))
    near = keys[:20] ^ (np.uint64(1) << rng.integers(0, 64, 20).astype(np.uint64))
    keys = np.sort(np.r_[keys, near, keys[:5]])
    top = 8
    linked = lambda i, j: keys[i] >> np.uint64(56) == keys[j] >> np.uint64(56) and bin(int(keys[i] ^ keys[j])).count("1") <= 3
    assert simhash.trie_groups(keys, top, 3).tolist() == smallest_reachable(len(keys), linked)
    odd = lambda i, j: (i + j) % 2 == 1
    both = lambda i, j: linked(i, j) and odd(i, j)
    assert simhash.trie_groups(keys, top, 3, odd).tolist() == smallest_reachable(len(keys), both)


def test_near_duplicates_match_brute_force(spark, docs):
    rng = random.Random(5)
    base = [" ".join(rng.choice("the of and Stone river light ÉT é x1".split()) for _ in range(n)) for n in (1, 2, 3, 40, 80, 150)]
    rows = [(i, t) for i, t in enumerate(base * 2)]
    for i in range(40):
        w = base[rng.randrange(3, 6)].split()
        w[rng.randrange(len(w))] = "new"
        rows.append((100 + i, " \t".join(w)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "\u00a0"), (204, "word " * 20_000), (205, "word " * 20_000), (205, "word " * 20_000)]
    prints = [fingerprint(t) for _, t in rows]
    label = smallest_reachable(len(rows), lambda i, j: bin(prints[i] ^ prints[j]).count("1") <= 3)
    best = {}
    for (i, _), c in zip(rows, label):
        best[c] = min(best.get(c, i), i)
    want = sorted((i, f"{p:016x}", best[c]) for (i, _), p, c in zip(rows, prints, label))
    assert sorted(map(tuple, simhash.near_duplicates(docs(rows)).collect())) == want


def test_hash_is_the_one_of_the_engine(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b é"))).first()[0]
    assert got % (1 << 64) == int(simhash.shingle_hashes("A b é")[0])


def test_null_ids_and_empty_tables(spark, docs):
    rows = simhash.near_duplicates(docs([(None, "a b c"), (7, "a b c"), (None, "other words here now")])).collect()
    assert sorted(str(r["component_id"]) for r in rows) == ["7", "7", "None"]
    assert simhash.near_duplicates(docs([])).count() == 0
    assert simhash.similar_documents(docs([])).count() == 0


def test_similar_documents(spark, docs):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    base = [[word() for _ in range(200)] for _ in range(8)]
    rows, near = [], []
    for b, words in enumerate(base):
        rows.append((b * 100, " ".join(words)))
        for k in range(1, 8):
            copy = list(words)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(200)] = word()
            rows.append((b * 100 + k, " ".join(copy)))
            near.append((b * 100 + k, b * 100))
        half = words[:100] + [word() for _ in range(100)]
        rows.append((b * 100 + 50, " ".join(half)))
    got = {r[0]: r[1] for r in simhash.similar_documents(docs(rows)).collect()}
    assert all(got[i] == got[j] for i, j in near)
    assert all(got[b * 100 + 50] == b * 100 + 50 for b in range(8))
    kept = simhash.first_of_each(docs(rows + [(900, None), (901, "")]))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([b * 100 for b in range(8)] + [b * 100 + 50 for b in range(8)] + [900])


def jaccard(s, t):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (s.split(), t.split()))
    return len(a & b) / len(a | b)


def test_similar_documents_match_brute_force_for_every_shape_of_edit(spark, docs):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    words = lambda n: rng.choices(vocabulary, k=n)
    texts = []
    for b in range(60):
        n = rng.choice((60, 100, 300))
        base, k = words(n), int(n * rng.uniform(0.08, 0.3))
        at = rng.randrange(n - k)
        texts.append(base)
        texts.append([base + words(k), base[: n - k], base[:at] + words(k // 2) + base[at + k // 2 :]][b % 3])
        texts.append(words(k) + base)
    # A family whose members are alike in pairs only, and one word set in many orders.
    family = words(400)
    texts += [family[i : i + 200] for i in range(0, 200, 12)]
    small = words(40)
    texts += [rng.sample(small, 40) for _ in range(30)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    label = smallest_reachable(len(rows), lambda i, j: abs(i - j) < 40 and jaccard(rows[i][1], rows[j][1]) >= 0.8)
    got = dict(map(tuple, simhash.similar_documents(docs(rows)).collect()))
    assert [got[i] for i in range(len(rows))] == label
    assert sum(i != c for i, c in enumerate(label)) > 30


def test_first_of_each_keeps_one_row(spark, docs):
    rng = random.Random(4)
    text, other = (" ".join(rng.choices("abcdefghijklmnop", k=200)) for _ in range(2))
    rows = [(1, text), (1, text), (1, text + " q"), (2, text), (1, other), (None, other), (None, "x y"), (None, "x y"), (5, None), (5, "")]
    kept = [(r["doc_id"], r["text"]) for r in simhash.first_of_each(docs(rows)).collect()]
    assert len(kept) == 4 and (1, other) in kept and (None, "x y") in kept
    assert {(1, text), (1, text + " q")} & set(kept) and {(5, None), (5, "")} & set(kept)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)] + [(5, 5), (None, 3)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, components.components(frame).collect()))
    nodes = sorted({x for e in edges for x in e if x is not None})
    pairs = {frozenset(e) for e in edges if None not in e}
    place = {x: i for i, x in enumerate(nodes)}
    label = smallest_reachable(len(nodes), lambda i, j: frozenset((nodes[i], nodes[j])) in pairs)
    assert {x: got.get(x, x) for x in nodes} == {x: nodes[label[place[x]]] for x in nodes}
    assert components.components(frame.limit(0)).count() == 0


def test_no_key_is_split_after_a_join_on_it(spark):
    rows = spark.range(40000).select(
        (F.col("id") % 20000).alias("key"),
        F.col("id").alias("entry"),
        F.unhex(F.lit("00" * 24)).alias("sketch"),
        F.lit(10).cast("long").alias("size"),
    )
    walked = spark.range(20000).select(F.col("id").alias("key")).distinct()
    joined = rows.repartition(8).join(walked, "key", "left_semi")
    joined = joined.withColumns({"component": F.col("entry"), "refuted": F.lit(None).cast("array<long>")})
    pairs = simhash._named_pairs(joined, 0.8, 1)
    assert "xxhash64(key" in pairs._jdf.queryExecution().toString()
    assert pairs.where("a - b = 20000 and a % 20000 = key").distinct().count() == 20000


def test_sizes_and_wide_sketches_leave_near_pairs_alone(spark):
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
        # 450 of 550 hashes shared: 0.82; all of the smaller set: 0.8.
        sets += [base, np.r_[base[50:], rng.integers(0, 1 << 63, 50, dtype=np.uint64)], base[:400]]
    body = np.frombuffer(b"".join(simhash.wide_sketches(sets)), np.uint64).reshape(len(sets), -1)
    size = np.array([len(s) for s in sets])
    first = np.arange(0, len(sets), 3)
    assert simhash._may_be_near(body, size, first, first + 1, 0.8).all()
    assert simhash._may_be_near(body, size, first, first + 2, 0.8).all()
    assert not simhash._may_be_near(body, size, first, np.roll(first, 3), 0.8).any()
    assert simhash.wide_sketches([np.zeros(0, np.uint64)]) == [bytes(simhash.WIDE // 8)]


def test_links_joined_in_parts(spark, monkeypatch):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    frame = spark.createDataFrame(edges, "a long, b long")
    whole = dict(map(tuple, simhash._joined_links(frame).collect()))
    monkeypatch.setattr(simhash, "EDGES_AT_ONCE", 30)
    assert dict(map(tuple, simhash._joined_links(frame).collect())) == whole
    assert whole == dict(map(tuple, components.components(frame).collect()))
    assert simhash._joined_links(frame.limit(0)).count() == 0


def alike_but_not_near(rng, side):
    """``side`` ** 2 texts of pairwise similarity 0.73 or 0.77, and two copies of every tenth with one word replaced."""
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    base = [word() for _ in range(200)]
    texts = []
    for x in range(side):
        for y in range(side):
            # Two texts share one of their three places at most.
            text = list(base)
            for at in (x, side + y, 2 * side + (x + y) % side):
                text[5 * at + 5] = word()
            texts.append(text)
    texts += [text[:2] + [word()] + text[3:] for text in texts[::10] for _ in range(2)]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def smallest_similar(rows):
    near = {(i, j) for i, s in rows for j, t in rows if j < i and jaccard(s, t) >= 0.8}
    return smallest_reachable(len(rows), lambda i, j: (i, j) in near or (j, i) in near)


def test_pairs_of_a_large_group_of_alike_texts_are_no_rows(spark, docs, monkeypatch):
    rows = alike_but_not_near(random.Random(11), 11)
    label = smallest_similar(rows)
    asked, compared = [], simhash._compared
    monkeypatch.setattr(simhash, "_compared", lambda pairs, *rest: asked.append(pairs.count()) or compared(pairs, *rest))
    got = dict(map(tuple, simhash.similar_documents(docs(rows)).collect()))
    assert [got[i] for i in range(len(rows))] == label
    assert len(set(label)) > 50
    assert sum(asked) <= 2 * len(rows)


def test_families_in_blocks_lose_no_link(spark, docs, monkeypatch):
    rows = alike_but_not_near(random.Random(12), 8)
    label = smallest_similar(rows)
    monkeypatch.setattr(simhash, "BLOCK", 9)
    got = dict(map(tuple, simhash.similar_documents(docs(rows)).collect()))
    assert [got[i] for i in range(len(rows))] == label


@pytest.mark.parametrize("blocks", [1, 2])
def test_linked_sets_match_all_pairs(blocks):
    rng = np.random.default_rng(blocks)
    for n in (2, 9, 40):
        base = rng.integers(0, 1 << 62, 150, dtype=np.uint64)
        sets = [np.unique(np.r_[rng.permutation(base)[rng.integers(5, 40) :], rng.integers(0, 1 << 62, 5, dtype=np.uint64)]) for _ in range(n)]
        component, block = rng.integers(0, n, n), np.arange(n) % blocks
        same = lambda i, j: len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) >= 0.8
        linked = lambda i, j: component[i] == component[j] or ((blocks == 1 or block[i] != block[j]) and same(i, j))
        wide = np.frombuffer(b"".join(simhash.wide_sketches(sets)), np.uint64).reshape(n, -1)
        for sketch in (None, wide):
            a, b = simhash.linked_sets(sets, sketch, component.copy(), block, 0.8)
            stars = set(zip(a.tolist(), b.tolist())) | set(zip(b.tolist(), a.tolist()))
            joined = smallest_reachable(n, lambda i, j: component[i] == component[j] or (i, j) in stars)
            assert joined == smallest_reachable(n, linked)
            assert len(a) < len(np.unique(component))
