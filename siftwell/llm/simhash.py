"""SimHash near-duplicates by a self-join of binary tries.

A fingerprint has 64 bits; a bit is one if it is set in over half of the hashes of a text's word
shingles. Equal fingerprints are merged first, so copies cost one entry. Two fingerprints link when
they differ in ``bits`` bits or fewer.

The trie is stored four times (``bits`` + 1 times), each time with another stretch of bits on top,
and cut below that stretch. Two fingerprints within the budget agree on at least one stretch, so
every link lies inside a subtree of one of the tries. A subtree is joined with itself in one task:
pairs of nodes are walked together, the bits in which their paths differ are counted, and a pair
beyond the budget is dropped. Nodes whose entries are already in one group are dropped as well, and
a subtree returns a spanning star per group instead of its pairs. Subtrees do not grow with the
number of copies: what is equal is merged, and there are at most 43,745 different fingerprints
within 3 bits of one.

``similar_documents`` links texts whose sets of word shingles have a Jaccard similarity of at least
``similarity``. Texts with equal sets (by a 64-bit hash) are one entry. Entries meet by MinHash: the
smallest of the shingles under ``BANDS`` x ``BAND_ROWS`` orders, ``BAND_ROWS`` of them to a key, so a
pair at 0.8 shares no key with probability (1 - 0.8 ** 6) ** 32 < 1e-4, whatever the shape of the
edit. One bit per minimum is the entry's sketch; pairs whose sketches differ by four standard
deviations more than expected, or whose sets are too unequal in size, are left alone, all others are
decided by their whole sets of shingles.
Two passes, over a few keys and then over the others, settle most: every entry of a key names its
first entry of another component, the named pairs are compared and components joined. What shares a
key that still holds two components is then brought together, once and with its whole sets: entries
linked by such keys are a family, and in it every pair of components that sizes and sketches allow
is compared inside a task, which returns links only. A family of more than ``BLOCK`` entries is dealt
to blocks, and every pair of blocks is a group of its own. So no pair that met is left out, and the
rows that move grow with the pairs of blocks, not of texts.

Cases: a text of fewer words than a shingle is one shingle; no words (null, empty, white space)
give fingerprint zero, which links like any other. A row with a null id gets the component of its
fingerprint but can give none. Repeated rows stay. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.batches import hand_back
from siftwell.llm.components import components
from siftwell.llm.suffixes import mix
from siftwell.runtime import cut_lineage

SHINGLE = 3
BITS = 3
SEED = 42
SIMILARITY = 0.8
SIMILAR_SHINGLE = 5
BANDS = 32
BAND_ROWS = 6
# The first round looks at so many keys of a text, the second at the others.
KEYS_AT_FIRST = 4
# Entries of a family, and hashes of their sets, that a block holds, about.
BLOCK = 2048
BLOCK_HASHES = 1 << 20
# Families of so many entries compare sketches of ``WIDE`` bits before sets.
WIDE_FROM = 64
# Bits of those sketches, and sets whose bits are found at once.
WIDE = 1024
SETS_AT_ONCE = 512
# Links that one task joins.
EDGES_AT_ONCE = 1 << 19
# Rows of 24 bytes that a join sends to every executor.
SENT_TO_ALL = 500_000
# Shingles whose bits are counted at once, and node pairs that are walked at once.
COUNT_AT_ONCE = 1 << 17
PAIRS_AT_ONCE = 1 << 18
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle of a text's words."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    n = max(1, len(words) - size + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = ends[min(size, len(words)) - 1 :]
    cuts = map(line.__getitem__, map(slice, starts[:n].tolist(), last.tolist()))
    return np.fromiter(map(xxhash.xxh64_intdigest, cuts, repeat(SEED)), np.uint64, n)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def _majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints of several texts from their hashes, laid end to end."""
    totals = np.zeros((len(sizes), 64), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for at in range(0, len(hashes), COUNT_AT_ONCE):
        part, own = hashes[at : at + COUNT_AT_ONCE], owner[at : at + COUNT_AT_ONCE]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        totals[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    ones = (2 * totals > sizes[:, None]).astype(np.uint8)
    return np.packbits(ones, axis=1).view(">u8").ravel().astype(np.uint64)


def _joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), sizes


def _batched(column: pa.ChunkedArray | pa.Array, hashed) -> Iterator[list]:
    """What ``hashed`` gives for the texts of a column, in groups of about COUNT_AT_ONCE hashes."""
    held, size = [], 0
    for text in column:
        held.append(hashed(text.as_py()))
        size += len(held[-1])
        if size > COUNT_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def fingerprints(documents: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """(``doc``, ``print``); the 64 bits are a signed long."""
    source = documents.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = _batched(batch.column(1), lambda t: shingle_hashes(t, shingle))
            found = [_majority(*_joined(g)) for g in groups]
            prints = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc", "print"])

    return source.mapInArrow(run, "doc long, print long")


def _roots(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Smallest reachable index after adding edges a-b to a forest of labels."""
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            return label
        label = new


def trie_groups(keys: np.ndarray, top: int, bits: int, agree=None) -> np.ndarray:
    """For sorted 64-bit keys: the smallest index each is linked to through keys that share their
    ``top`` highest bits, differ in ``bits`` bits or fewer and, if ``agree`` is given, pass it."""
    n = len(keys)
    label = np.arange(n)

    def linked(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        close = np.flatnonzero((i != j) & (np.bitwise_count(keys[i] ^ keys[j]) <= bits))
        if agree is None or not len(close):
            return close
        return close[agree(i[close], j[close])]

    if n < 2:
        return label
    shift = np.uint64(64 - top)
    head = keys >> shift
    # Neighbours in trie order are the likeliest links; grouping them first lets whole nodes drop out.
    near = np.flatnonzero(head[1:] == head[:-1])
    near = near[linked(near, near + 1)]
    if len(near):
        label = _roots(near, near + 1, label)
    first = np.flatnonzero(np.r_[True, head[1:] != head[:-1]])
    last = np.r_[first[1:], n]
    stack: list = [(top, first, last, first, last, np.zeros(len(first), np.int8))]
    while stack:
        if not isinstance(stack[-1], tuple):
            # Pairs below leaves come in bounded numbers.
            pairs = next(stack[-1], None)
            if pairs is None:
                stack.pop()
                continue
            stack.append(pairs)
        depth, al, ah, bl, bh, diff = stack.pop()
        if len(al) > PAIRS_AT_ONCE:
            stack.append((depth, *(x[PAIRS_AT_ONCE:] for x in (al, ah, bl, bh, diff))))
            al, ah, bl, bh, diff = (x[:PAIRS_AT_ONCE] for x in (al, ah, bl, bh, diff))
        # Drop pairs of nodes that lie within one group already.
        changes = np.r_[0, np.cumsum(label[1:] != label[:-1])]
        even = (changes[ah - 1] == changes[al]) & (changes[bh - 1] == changes[bl]) & (label[al] == label[bl])
        al, ah, bl, bh, diff = (x[~even] for x in (al, ah, bl, bh, diff))
        single = (ah - al == 1) & (bh - bl == 1)
        if single.any():
            i, j = al[single], bl[single]
            close = linked(i, j)
            if len(close):
                label = _roots(i[close], j[close], label)
            al, ah, bl, bh, diff = (x[~single] for x in (al, ah, bl, bh, diff))
        if not len(al):
            continue
        if depth == 64:
            # Nodes of equal keys: their entries are walked one by one.
            stack.append(_within(al, ah, bl, bh, diff))
            continue
        bit = np.uint64(1) << np.uint64(63 - depth)
        above = ~(bit | (bit - np.uint64(1)))

        def middle(low, high, bit=bit, above=above):
            return np.clip(np.searchsorted(keys, (keys[low] & above) | bit), low, high)

        am, bm = middle(al, ah), middle(bl, bh)
        own = al == bl
        other = ~own
        children = [
            (al, am, bl, bm, diff),
            (am, ah, bm, bh, diff),
            (al, am, bm, bh, diff + 1),
            tuple(x[other] for x in (am, ah, bl, bm, diff + 1)),
        ]
        al, ah, bl, bh, diff = (np.concatenate(x) for x in zip(*children, strict=True))
        live = (ah > al) & (bh > bl) & (diff <= bits)
        stack.append((depth + 1, *(x[live] for x in (al, ah, bl, bh, diff))))
    return label


def _within(al, ah, bl, bh, diff) -> Iterator[tuple]:
    """Pairs of entries below pairs of leaves, a bounded number at a time."""
    sizes = (ah - al) * (bh - bl)
    ends = np.cumsum(sizes)
    for at in range(0, int(ends[-1]), PAIRS_AT_ONCE):
        number = np.arange(at, min(at + PAIRS_AT_ONCE, int(ends[-1])))
        leaf = np.searchsorted(ends, number, side="right")
        inner = number - (ends[leaf] - sizes[leaf])
        i, j = al[leaf] + inner // (bh - bl)[leaf], bl[leaf] + inner % (bh - bl)[leaf]
        once = i < j
        i, j = i[once], j[once]
        yield 64, i, i + 1, j, j + 1, diff[leaf][once]


def links(entries: DataFrame, bits: int) -> DataFrame:
    """(``a``, ``b``): a spanning set of links between entries ``rep`` (unique long) by their ``print``."""
    tries = bits + 1
    borders = [64 * t // tries for t in range(tries + 1)]
    # The height of the cut differs by a bit at most between tries when 64 is no multiple of them.
    top = min(borders[t + 1] - borders[t] for t in range(tries))
    turned = [F.struct(F.lit(t).alias("trie"), _turned(F.col("print"), borders[t]).alias("key")) for t in range(tries)]
    rows = entries.select("rep", F.explode(F.array(*turned)).alias("e")).select("e.trie", "e.key", "rep")
    # Flipping the sign bit sorts signed longs as unsigned ones.
    rows = rows.repartition("trie", F.shiftrightunsigned("key", 64 - top)).sortWithinPartitions(
        "trie", F.col("key").bitwiseXOR(F.lit(-(1 << 63)))
    )

    def close(trie, keys, reps):
        label = trie_groups(keys, top, bits)
        linked = np.flatnonzero(label != np.arange(len(keys)))
        return pa.RecordBatch.from_arrays([pa.array(reps[linked]), pa.array(reps[label[linked]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Subtrees come in order; those that are complete are joined as soon as a batch has them."""
        kept: tuple | None = None
        for batch in batches:
            part = (
                batch.column(0).to_numpy(zero_copy_only=False),
                batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64),
                batch.column(2).to_numpy(zero_copy_only=False),
            )
            if kept is not None:
                part = tuple(np.concatenate(x) for x in zip(kept, part, strict=True))
            trie, keys = part[:2]
            if not len(keys):
                continue
            last = (trie == trie[-1]) & (keys >> np.uint64(64 - top) == keys[-1] >> np.uint64(64 - top))
            begin = int(np.argmax(last))
            for t in np.unique(trie[:begin]):
                at = np.flatnonzero(trie[:begin] == t)
                yield close(*(x[at] for x in part))
            kept = tuple(x[begin:] for x in part)
        if kept is not None and len(kept[0]):
            yield close(*kept)

    return rows.mapInArrow(run, "a long, b long")


def _turned(value: Column, by: int) -> Column:
    """The 64 bits moved ``by`` places to the left, around the end."""
    if not by:
        return value
    return F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, 64 - by))


def _named(prints: DataFrame, bits: int) -> DataFrame:
    """``prints`` (``doc``, ``print``) with ``component_id``; rows equal in ``print`` are one entry."""
    entries = cut_lineage(prints.groupBy("print").agg(F.min("doc").alias("rep")))
    found = components(links(entries.where(F.col("rep").isNotNull()), bits))
    named = entries.join(found, entries["rep"] == found["node"], "left").select(
        "print", F.coalesce("component", "rep").alias("component_id")
    )
    return prints.join(named, "print")


def near_duplicates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """(id as long, ``fingerprint`` as 16 hex digits, ``component_id``) for every row."""
    prints = cut_lineage(fingerprints(documents, doc_id, text, shingle))
    return _named(prints, bits).select(
        F.col("doc").alias(doc_id),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def far_for(similarity: float, width: int) -> int:
    """Differing bits, of ``width``, that sketches of a pair of the given similarity stay within but
    for four standard deviations."""
    # Two minima differ with probability 1 - s, their bits in half of these cases.
    share = (1 - similarity) / 2
    return math.ceil(width * share + 4 * math.sqrt(width * share * (1 - share)))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, size))


def _minima(sets: list[np.ndarray], orders: int = BANDS * BAND_ROWS) -> np.ndarray:
    """(sets, orders): the smallest hash of each set, none of them empty, under every order."""
    hashes, sizes = _joined(sets)
    first = np.r_[0, np.cumsum(sizes)[:-1]]
    # Orders are fixed, so that all tasks and runs agree.
    salts = mix(np.arange(1, 2 * orders + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(2, -1)
    out = [np.minimum.reduceat((hashes ^ x) * (m | np.uint64(1)), first) for x, m in salts.T]
    return np.stack(out, axis=1)


def signatures(texts: list[np.ndarray]) -> tuple[list[int], list[np.ndarray], list[bytes]]:
    """Hash of the whole set, keys and sketch of every set of shingles; empty sets have no keys."""
    whole = [xxhash.xxh64_intdigest(t.tobytes(), SEED) for t in texts]
    keys, sketch = [np.zeros(0, np.int64)] * len(texts), [bytes(BANDS * BAND_ROWS // 8)] * len(texts)
    full = [i for i, t in enumerate(texts) if len(t)]
    if full:
        least = mix(_minima([texts[i] for i in full]))
        bands = least.reshape(len(full), BANDS, BAND_ROWS)
        key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bands.shape[:2])
        for r in range(BAND_ROWS):
            key = mix((key + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ bands[:, :, r])
        bits = np.packbits((least >> np.uint64(63)).astype(np.uint8), axis=1)
        for n, i in enumerate(full):
            keys[i], sketch[i] = key[n].view(np.int64), bits[n].tobytes()
    return whole, keys, sketch


def wide_sketches(texts: list[np.ndarray]) -> list[bytes]:
    """One bit for the minimum of each of ``WIDE`` orders; a set without shingles has zeros."""
    out, full = [bytes(WIDE // 8)] * len(texts), [i for i, t in enumerate(texts) if len(t)]
    for at in range(0, len(full), SETS_AT_ONCE):
        some = full[at : at + SETS_AT_ONCE]
        least = mix(_minima([texts[i] for i in some], WIDE))
        for i, bits in zip(some, np.packbits((least >> np.uint64(63)).astype(np.uint8), axis=1), strict=True):
            out[i] = bits.tobytes()
    return out


def _name_pairs(entry, sketch, component, refuted: list, size, similarity: float, quota: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of entries of one key, as indices: for each entry its first ``quota`` others of another
    component that may be near, without ``refuted`` ones (entries, or None). No pair inside the
    component with most entries is looked at."""
    number, members = np.unique(component, return_inverse=True, return_counts=True)[1:]
    if len(members) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    large = number == members.argmax()
    left, others = np.arange(len(entry)), np.flatnonzero(~large)
    got = np.zeros(len(entry), np.int64)
    a, b = [], []
    for at in range(0, len(others), 256):
        y = others[at : at + 256]
        for start in range(0, len(left), 4096):
            x = left[start : start + 4096]
            near = (number[x][:, None] != number[y]) & (large[x][:, None] | (x[:, None] > y))
            i, j = np.nonzero(near)
            i, j = x[i], y[j]
            close = _may_be_near(sketch, size, i, j, similarity)
            i, j = i[close], j[close]
            known = np.array([refuted[p] is not None and entry[q] in refuted[p] for p, q in zip(i, j, strict=True)], bool)
            i, j = i[~known], j[~known]
            place = got[i] + np.arange(len(i)) - np.searchsorted(i, i)
            i_new, j_new = i[place < quota], j[place < quota]
            np.add.at(got, i_new, 1)
            a.append(i_new)
            b.append(j_new)
        left = left[got[left] < quota]
    return np.concatenate(a), np.concatenate(b)


def _may_be_near(sketch, size, i, j, similarity: float) -> np.ndarray:
    """Whether the sizes of sets i and j allow the similarity and their sketches suggest it."""
    near = np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j])
    at = np.flatnonzero(near)
    differ = np.bitwise_count(sketch[i[at]] ^ sketch[j[at]]).sum(axis=1, dtype=np.int64)
    near[at] = differ <= far_for(similarity, 64 * sketch.shape[1])
    return near


def _named_pairs(rows: DataFrame, similarity: float, quota: int) -> DataFrame:
    """(``key``, ``a``, ``b``) from (``key``, ``entry``, ``sketch``, ``component``, ``refuted``, ``size``)."""

    def close(part: tuple, first: np.ndarray) -> pa.RecordBatch:
        """The pairs of all keys of ``part``, that begin at ``first``, as one batch."""
        _, entry, sketch, component, refuted, size = part
        ends = np.r_[first[1:], len(entry)]
        # Most keys with several entries have two; those are looked at together.
        j = first[ends - first == 2]
        near = (component[j] != component[j + 1]) & _may_be_near(sketch, size, j, j + 1, similarity)
        j = [x for x in j[near].tolist() if refuted[x + 1] is None or entry[x] not in refuted[x + 1]]
        a, b = [np.array(j, np.int64) + 1], [np.array(j, np.int64)]
        more = ends - first > 2
        for low, high in zip(first[more].tolist(), ends[more].tolist(), strict=True):
            i, j = _name_pairs(*(x[low:high] for x in part[1:]), similarity, quota)
            a.append(i + low)
            b.append(j + low)
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.RecordBatch.from_arrays([pa.array(part[0][a]), pa.array(entry[a]), pa.array(entry[b])], ["key", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            refuted = np.empty(batch.num_rows, object)
            refuted[:] = [r and frozenset(r) for r in batch.column(4).to_pylist()]
            body = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64).reshape(batch.num_rows, -1)
            key, entry, component, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1, 3, 5))
            part = (key, entry, body, component, refuted, size)
            if kept is not None:
                part = tuple(np.concatenate(x) for x in zip(kept, part, strict=True))
            # The last key may go on in the next batch.
            first = np.flatnonzero(np.r_[True, part[0][1:] != part[0][:-1]])
            if len(first) > 1:
                yield close(tuple(x[: first[-1]] for x in part), first[:-1])
            kept = tuple(x[first[-1] :] for x in part)
        if kept is not None:
            yield close(kept, np.zeros(1, np.int64))

    # By a function of the key: rows that a join has already dealt by the key itself would not be dealt
    # again, and adaptive execution may then read the join's partitions in pieces that split a key.
    dealt = rows.select("key", "entry", "sketch", "component", "refuted", "size").repartition(F.xxhash64("key"))
    return dealt.sortWithinPartitions("key", "entry").mapInArrow(run, "key long, a long, b long")


def _compared(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(``a``, ``b``, ``same``) of pairs of entries, by the whole sets of shingles of their texts."""
    one = lambda side: texts.select(F.col("entry").alias(side), F.col("text").alias(f"text_{side}"))
    both = pairs.join(one("b"), "b").join(one("a"), "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = []
            for s, t in zip(batch.column(2), batch.column(3), strict=True):
                s, t = shingle_set(s.as_py(), shingle), shingle_set(t.as_py(), shingle)
                shared = len(np.intersect1d(s, t, assume_unique=True))
                same.append(shared >= similarity * (len(s) + len(t) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same, pa.bool_())], ["a", "b", "same"])
        hand_back()

    return both.mapInArrow(run, "a long, b long, same boolean")


def linked_sets(
    sets: list[np.ndarray], sketch: np.ndarray | None, component: np.ndarray, block: np.ndarray, similarity: float
) -> tuple[np.ndarray, np.ndarray]:
    """Links, as indices, that join the components of similar sets: of one block all pairs count, of two
    blocks those between them. Pairs inside a component, also one that was just joined, are not looked at."""
    size = np.array([len(x) for x in sets], np.int64)
    rank = np.argsort(size, kind="stable")
    size, label, block = size[rank], component[rank], block[rank]
    sketch = None if sketch is None else sketch[rank]
    hashes, place = np.unique(np.concatenate([sets[i] for i in rank]), return_inverse=True)
    places = np.split(place, np.cumsum(size)[:-1])
    held = np.zeros(len(hashes), bool)
    least, across = similarity * size, block.min() < block.max()
    a, b = [], []
    for x in range(len(rank) - 1):
        y = np.arange(x + 1, np.searchsorted(least, size[x], side="right"))
        y = y[label[y] != label[x]]
        if across:
            y = y[block[y] != block[x]]
        if sketch is not None and len(y):
            y = y[_may_be_near(sketch, size, np.full(len(y), x), y, similarity)]
        if not len(y):
            continue
        held[places[x]] = True
        # The texts of a piece have about COUNT_AT_ONCE hashes.
        for some in np.split(y, np.flatnonzero(np.diff(np.cumsum(size[y]) // COUNT_AT_ONCE)) + 1):
            found = held[np.concatenate([places[i] for i in some])]
            shared = np.add.reduceat(found, np.r_[0, np.cumsum(size[some])[:-1]], dtype=np.int64)
            some = some[shared >= similarity * (size[x] + size[some] - shared)]
            other, first = np.unique(label[some], return_index=True)
            new = other != label[x]
            a.append(np.full(int(new.sum()), x))
            b.append(some[first[new]])
            if new.any():
                label[np.isin(label, other)] = label[x]
        held[places[x]] = False
    none = [np.zeros(0, np.int64)]
    return rank[np.concatenate(a or none)], rank[np.concatenate(b or none)]


def _families(held: DataFrame, refuted: DataFrame) -> DataFrame:
    """(``entry``, ``family``) of the entries that share a key with another component, directly or through others.

    ``held`` has ``key``, ``entry`` and ``component``. A key of two entries that are in ``refuted`` (``a``, ``b``) is decided."""
    low, high = F.min("entry").alias("low"), F.when(F.count(F.lit(1)) == 2, F.max("entry")).alias("high")
    undecided = held.groupBy("key").agg(low, high, (F.min("component") != F.max("component")).alias("mixed")).where("mixed")
    gone = refuted.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct()
    undecided = undecided.join(gone, ["low", "high"], "left_anti").select("key", F.col("low").alias("b"))
    near = _joined_links(cut_lineage(held.join(undecided, "key").select(F.col("entry").alias("a"), "b").distinct()))
    first = near.select(F.col("component").alias("node"), "component").distinct()
    return near.unionByName(first).select(F.col("node").alias("entry"), F.col("component").alias("family"))


def _family_links(members: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(``a``, ``b``): links that join what is similar in each family, from its ``entry``, ``text``, ``component``,
    ``family``, the number ``n`` of its entries and the number of ``blocks`` they are dealt to."""

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["entry", "component", "family", "blocks", "sets", "sketch"]
        for batch in batches:
            at = 0
            for group in _batched(batch.column(4), lambda t: shingle_set(t, shingle)):
                rows = batch.slice(at, len(group))
                at += len(group)
                large = np.flatnonzero(rows.column(5).to_numpy(zero_copy_only=False) >= WIDE_FROM).tolist()
                sketch: list = [None] * len(group)
                for i, bits in zip(large, wide_sketches([group[i] for i in large]), strict=True):
                    sketch[i] = bits
                sets = pa.array([s.tobytes() for s in group], pa.binary())
                yield pa.RecordBatch.from_arrays([*rows.columns[:4], sets, pa.array(sketch, pa.binary())], names)
        hand_back()

    def linked(rows: pa.RecordBatch) -> list[np.ndarray]:
        entry, component, block = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("entry", "component", "block"))
        sketch = rows.column("sketch").to_pylist()
        wide = None if sketch[0] is None else np.frombuffer(b"".join(sketch), np.uint64).reshape(len(sketch), -1)
        sets = [np.frombuffer(s, np.uint64) for s in rows.column("sets").to_pylist()]
        return [entry[x] for x in linked_sets(sets, wide, component.copy(), block, similarity)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups come in order; those that are complete are compared as soon as a batch has them."""
        kept: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            group = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("family", "low", "high")]
            changes = np.any([x[1:] != x[:-1] for x in group], axis=0)
            first = [0, *(np.flatnonzero(changes) + 1).tolist()]
            if last is not None and last != tuple(x[0] for x in group):
                yield stars([pa.concat_batches(kept)])
                kept = []
            if len(first) > 1:
                whole = [pa.concat_batches([*kept, batch.slice(0, first[1])])]
                yield stars(whole + [batch.slice(at, end - at) for at, end in zip(first[1:-1], first[2:], strict=True)])
                kept = []
            kept.append(batch.slice(first[-1]))
            last = tuple(x[-1] for x in group)
        if kept:
            yield stars([pa.concat_batches(kept)])
        hand_back()

    def stars(groups: list[pa.RecordBatch]) -> pa.RecordBatch:
        a, b = (np.concatenate(side) for side in zip(*map(linked, groups), strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    kinds = "entry long, component long, family long, blocks long, sets binary, sketch binary"
    sets = members.select("entry", "component", "family", "blocks", "text", "n").mapInArrow(widen, kinds)
    dealt = sets.withColumn("block", F.pmod(F.xxhash64("entry"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "blocks")
    dealt = dealt.repartition(F.xxhash64("family", "low", "high")).sortWithinPartitions("family", "low", "high")
    return dealt.mapInArrow(run, "a long, b long")


def _joined_links(edges: DataFrame) -> DataFrame:
    """``components`` of edges, after those of each part were replaced by a spanning star per group in it.

    Parts hold ``EDGES_AT_ONCE`` edges, dealt in turn, so no node's edges gather in one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[column.to_numpy(zero_copy_only=False) for column in batch.columns] for batch in batches]
        if parts:
            a, b = (np.concatenate(side) for side in zip(*parts, strict=True))
            nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
            label = _roots(place[: len(a)], place[len(a) :], np.arange(len(nodes)))
            moved = np.flatnonzero(label != np.arange(len(nodes)))
            stars = [pa.array(nodes[moved]), pa.array(nodes[label[moved]])]
            yield pa.RecordBatch.from_arrays(stars, ["node", "component"])

    parts = max(1, math.ceil(edges.count() / EDGES_AT_ONCE))
    stars = cut_lineage(edges.repartition(parts).mapInArrow(run, "node long, component long"))
    if parts == 1:
        return stars
    return components(stars.select(F.col("node").alias("a"), F.col("component").alias("b")))


def unioned(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _similar(documents: DataFrame, doc_id: str, text: str, shingle: int, similarity: float) -> DataFrame:
    """(``doc``, ``body`` hash of the text, ``component``) for every row."""
    spark = documents.sparkSession
    body = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("body")
    source = documents.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"), body)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in _batched(batch.column(1), lambda t: shingle_set(t, shingle)):
                whole, keys, sketch = signatures(group)
                rows = batch.slice(at, len(group))
                at += len(group)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        rows.column(2),
                        pa.array(np.array(whole, np.uint64).view(np.int64)),
                        pa.array(keys, pa.list_(pa.int64())),
                        pa.array(sketch, pa.binary()),
                        pa.array([len(s) for s in group], pa.int64()),
                    ],
                    ["doc", "body", "entry", "keys", "sketch", "size"],
                )
        hand_back()

    kinds = "doc long, body long, entry long, keys array<long>, sketch binary, size long"
    prints = cut_lineage(source.mapInArrow(run, kinds))
    firsts = [F.first(name).alias(name) for name in ("keys", "sketch", "size")]
    entries = cut_lineage(prints.groupBy("entry").agg(*firsts, F.min(F.struct("body", "doc")).alias("row")))

    def texts_of(needed: DataFrame, small: bool) -> DataFrame:
        """(``entry``, ``text``). One row of an entry is read, so copies are not sent; few needed rows leave
        the others where they are."""
        rows = needed.join(entries.select("entry", "row"), "entry")
        rows = F.broadcast(rows) if small else rows
        same_row = (F.col("row.body") == F.col("body")) & F.col("row.doc").eqNullSafe(F.col("doc"))
        return rows.join(source, same_row).select("entry", "text").dropDuplicates(["entry"])

    def with_links(new: DataFrame, found: DataFrame | None) -> DataFrame:
        return _joined_links(new if found is None else new.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    # A few keys at first: what they bring together needs no pair under the other keys.
    found, compared, named = None, [], []
    for keys in (F.slice("keys", 1, KEYS_AT_FIRST), F.slice("keys", KEYS_AT_FIRST + 1, BANDS)):
        rows = entries.select("entry", "sketch", "size", F.explode(keys).alias("key"))
        if compared:
            rows = rows.join(found, F.col("entry") == F.col("node"), "left")
            gone = unioned(compared).where(~F.col("same"))
            # Either entry of a pair may name the other.
            gone = gone.select("a", "b").unionByName(gone.select(F.col("b").alias("a"), F.col("a").alias("b")))
            rows = rows.join(gone.groupBy("a").agg(F.collect_list("b").alias("refuted")), F.col("entry") == F.col("a"), "left")
            rows = rows.withColumn("component", F.coalesce("component", "entry"))
        else:
            rows = rows.withColumns({"component": F.col("entry"), "refuted": F.lit(None).cast("array<long>")})
        named.append(cut_lineage(_named_pairs(rows, similarity, 1)))
        # What an entry names under other keys waits for the families.
        asked = cut_lineage(named[-1].groupBy("a").agg(F.min("b").alias("b")))
        number = asked.count()
        if number:
            read = texts_of(asked.select(F.explode(F.array("a", "b")).alias("entry")).distinct(), 2 * number <= SENT_TO_ALL)
            compared.append(cut_lineage(_compared(asked, read, shingle, similarity)))
            found = with_links(compared[-1].where("same").select("a", "b"), found)
    if compared:
        # Keys that named no pair hold nothing undecided.
        walked = unioned(named).select("key").distinct()
        held = entries.select("entry", F.explode("keys").alias("key")).join(walked, "key", "left_semi")
        held = held.join(found, F.col("entry") == F.col("node"), "left")
        held = cut_lineage(held.select("key", "entry", F.coalesce("component", "entry").alias("component")))
        members = _families(held, unioned(compared).where(~F.col("same")))
        members = cut_lineage(members.join(entries.select("entry", "size"), "entry"))
        shape = members.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("hashes"))
        blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("hashes") / BLOCK_HASHES)).alias("blocks")
        members = members.join(shape.select("family", "n", blocks), "family").join(found, F.col("entry") == F.col("node"), "left")
        members = cut_lineage(members.select("entry", "family", "n", "blocks", F.coalesce("component", "entry").alias("component")))
        number = members.count()
        if number:
            read = texts_of(members.select("entry"), number <= SENT_TO_ALL).join(members, "entry")
            found = with_links(cut_lineage(_family_links(read, shingle, similarity)), found)
    if found is None:
        return prints.select("doc", "body", F.col("entry").alias("component"))
    return prints.join(found, prints["entry"] == found["node"], "left").select(
        "doc", "body", F.coalesce("component", "entry").alias("component")
    )


def similar_documents(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SIMILAR_SHINGLE,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(id as long, ``component_id``) for every row: components of texts of the given similarity."""
    found = cut_lineage(_similar(documents, doc_id, text, shingle, similarity))
    least = found.groupBy("component").agg(F.min("doc").alias("component_id"))
    return found.join(least, "component").select(F.col("doc").alias(doc_id), "component_id")


def first_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component of similar texts, with its columns: the one with the smallest
    id, of several under that id the one with the smallest hash of its text, and of rows that repeat
    both any one. Rows with a null id stay only if their component has no row with an id."""
    found = _similar(documents, doc_id, text, SIMILAR_SHINGLE, SIMILARITY).groupBy("component", "doc", "body")
    first = found.count().groupBy("component").agg(F.min(F.struct(F.col("doc").isNull(), "doc", "body", "count")).alias("row"))
    keep = cut_lineage(first.select(F.col("row.doc").alias("_doc"), F.col("row.body").alias("_body"), F.col("row.count").alias("_n")))
    body = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    same = F.col(doc_id).cast("long").eqNullSafe(F.col("_doc")) & (body == F.col("_body"))
    kept = documents.join(keep.where("_n = 1"), same, "left_semi")
    repeated = keep.where("_n > 1")
    if repeated.isEmpty():
        return kept
    once = documents.join(repeated, same).dropDuplicates(["_doc", "_body"])
    return kept.unionByName(once.drop("_doc", "_body", "_n"))
