"""Finding benchmark passages in documents by winnowed k-gram fingerprints.

A window is ``window`` consecutive words of a benchmark item; an item with fewer words, but not
none, is one window. A document word inside any occurrence of a window is hit.

Of every ``window`` words, the smallest k-gram hash is kept as a fingerprint (the rightmost one if
several are equal), on both sides. Two equal windows keep the same fingerprint at the same place,
so an equi-join on the hash, aligned at that place, meets every shared window; the words of the
window are then compared. Windows of short items, at most ``window - 1`` lengths, are their own
fingerprint.

Documents are read once; only the fingerprints that meet a window, and one row per document, are
shuffled. The benchmark's windows are broadcast up to ``BROADCAST_BYTES``; beyond that the hashes
join by shuffle with the few words around each fingerprint.

Cases: null and empty texts have no words. Documents that repeat (also their id) come back as
often as they came in, each judged on its own text. Windows that several items share count for
each of them; a null item id is written as an empty text. Other columns are ignored.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.asciicase import lower_ascii
from siftwell.operators.unnest import unnest

WINDOW = 10
KGRAM = 5
BROADCAST_BYTES = 64 * 1024 * 1024
# Everything that is neither a digit, a lower-case letter nor beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; no words for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _gram(hashes: Column, at: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(hashes, at + j) for j in range(length)])


def _starts(length: Column | int, size: int) -> Column:
    """Places 0..length-size, none when the length is too small."""
    last = length - F.lit(size)
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def with_fingerprints(df: DataFrame, window: int, k: int) -> DataFrame:
    """Add ``picks``: one long per window of ``words``: the hash with its low bits replaced by
    the place of the fingerprint, counted from the end of the window."""
    spots = window - k + 1
    mask = (1 << (spots - 1).bit_length()) - 1
    hashed = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    grams = hashed.withColumn(
        "grams",
        F.transform(
            _starts(F.size("hashes"), k),
            lambda i: _gram(F.col("hashes"), i, k).bitwiseAND(F.lit(~mask)),
        ),
    )
    picked = F.transform(
        _starts(F.size("grams"), spots),
        lambda i: F.least(
            *[F.get(F.col("grams"), i + j).bitwiseOR(F.lit(spots - 1 - j)) for j in range(spots)]
        ),
    )
    return grams.withColumn("picks", picked)


def _mask(window: int, k: int) -> int:
    return (1 << (window - k).bit_length()) - 1


def benchmark_windows(items: DataFrame, window: int, k: int, item_id: str, text: str) -> DataFrame:
    """Distinct windows: ``gram`` (the fingerprint), ``back`` (its place from the window's start),
    ``passage`` (the words), ``n`` and ``items`` (ids as text)."""
    worded = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words_of(F.col(text)).alias("words")
    ).withColumn("n", F.size("words"))
    mask, spots = _mask(window, k), window - k + 1
    long = unnest(with_fingerprints(worded.where(F.col("n") >= window), window, k), F.col("picks"), "at", "pick")
    long = long.select(
        "item",
        F.col("pick").bitwiseAND(F.lit(~mask)).alias("gram"),
        (F.lit(spots - 1) - F.col("pick").bitwiseAND(F.lit(mask))).cast("int").alias("back"),
        F.slice("words", F.col("at") + 1, F.lit(window)).alias("passage"),
        F.lit(window).alias("n"),
    )
    short = worded.where((F.col("n") > 0) & (F.col("n") < window))
    short = short.select(
        "item",
        F.xxhash64(F.transform("words", lambda w: F.xxhash64(w))).alias("gram"),
        F.lit(0).alias("back"),
        F.col("words").alias("passage"),
        "n",
    )
    return long.unionByName(short).groupBy("gram", "back", "passage", "n").agg(F.collect_set("item").alias("items"))


def document_fingerprints(worded: DataFrame, window: int, k: int, short: list[int]) -> DataFrame:
    """Add ``marks``: array of (gram, place, n). A mark of null gram stands for the document."""
    mask, spots = _mask(window, k), window - k + 1
    picked = with_fingerprints(worded, window, k)
    place = lambda pick, i: (i + F.lit(spots - 1) - pick.bitwiseAND(F.lit(mask))).cast("int")
    mark = lambda gram, at, n: F.struct(gram.alias("gram"), at.alias("place"), n.alias("n"))
    picks = F.col("picks")
    # The place moves to the right only, so a fingerprint is new where it differs from the window before.
    fresh = F.filter(
        F.transform(
            picks,
            lambda p, i: F.when(
                (i == 0) | (place(p, i) != place(F.get(picks, i - 1), i - 1)),
                mark(p.bitwiseAND(F.lit(~mask)), place(p, i), F.lit(window)),
            ),
        ),
        lambda m: m.isNotNull(),
    )
    parts = [F.array(mark(F.lit(None).cast("long"), F.lit(-1), F.lit(0))), fresh]
    def whole(n: int) -> Column:
        gram = lambda i: F.xxhash64(F.slice("hashes", i + 1, F.lit(n)))
        return F.transform(_starts(F.size("hashes"), n), lambda i: mark(gram(i), i, F.lit(n)))

    parts += [whole(n) for n in short]
    return picked.select("doc", "sign", "words", F.concat(*parts).alias("marks"))


def contaminated(
    documents: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    k: int = KGRAM,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per document: id, ``n_words``, ``spans`` (array of start and n of the windows found) and
    ``items`` (sorted ids, as text, of the items they come from)."""
    if not 1 <= k <= window:
        raise ValueError("k must lie between 1 and the window")
    windows = benchmark_windows(items, window, k, item_id, item_text)
    # One row per length, at most ``window`` of them.
    sizes = windows.groupBy("n").agg(F.sum(F.length(F.concat_ws(" ", "passage"))).alias("size")).collect()
    short = sorted(r["n"] for r in sizes if r["n"] < window)
    small = sum(r["size"] for r in sizes) <= broadcast_bytes

    worded = documents.select(
        F.col(doc_id).alias("doc"),
        F.xxhash64(F.col(text)).alias("sign"),
        words_of(F.col(text)).alias("words"),
    )
    marked = document_fingerprints(worded, window, k, short)
    flat = marked.select("doc", "sign", F.size("words").alias("n_words"), "words", F.explode_outer("marks").alias("mark"))
    flat = flat.select("doc", "sign", "n_words", "words", "mark.gram", "mark.place", F.col("mark.n").alias("mark_n"))
    found = windows.select(
        F.col("gram").alias("w_gram"), "back", "passage", F.col("n").alias("w_n"), F.col("items").alias("w_items")
    )
    start = F.col("place") - F.col("back")
    if small:
        same = F.slice("words", start + 1, F.col("w_n")) == F.col("passage")
        found = F.broadcast(found)
    else:
        # The words a window around this fingerprint can have, instead of the whole document.
        first = F.greatest(F.col("place") - (window - k), F.lit(0))
        flat = flat.withColumns(
            {"words": F.slice("words", F.greatest(first, F.lit(0)) + 1, F.lit(2 * window)), "first": first}
        )
        same = F.slice("words", start - F.col("first") + 1, F.col("w_n")) == F.col("passage")
    on = (
        (F.col("gram") == F.col("w_gram"))
        & (F.col("mark_n") == F.col("w_n"))
        & (start >= 0)
        & F.when(start >= 0, same).otherwise(F.lit(False))
    )
    met = flat.join(found, on, "left").where(F.col("gram").isNull() | F.col("w_n").isNotNull())
    span = F.when(F.col("w_n").isNotNull(), F.struct(start.alias("start"), F.col("w_n").alias("n")))
    per_doc = met.groupBy("doc", "sign").agg(
        F.first("n_words").alias("n_words"),
        F.count(F.when(F.col("gram").isNull(), F.lit(1))).alias("copies"),
        F.collect_set(span).alias("spans"),
        F.collect_set("w_items").alias("item_sets"),
    )
    ids = F.array_sort(F.array_distinct(F.flatten("item_sets")))
    return per_doc.select(
        F.col("doc").alias(doc_id),
        F.col("n_words").cast("long").alias("n_words"),
        F.array_sort("spans").alias("spans"),
        ids.alias("items"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
    ).drop("_copy")


def covered(spans: Column) -> Column:
    """Number of words inside the spans, which are sorted by start."""
    empty = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))
    step = lambda a, s: F.struct(
        F.greatest(a["end"], s["start"] + s["n"]).alias("end"),
        (a["total"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(a["end"], s["start"]))).alias("total"),
    )
    return F.aggregate(spans, empty, step, lambda a: a["total"])


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The columns of ``contaminated`` as counts and a digest of the item ids."""
    hit = covered(F.col("spans"))
    return found.select(
        doc_id,
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def without_passages(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents in which no window of an item occurs, with their columns."""
    hit = contaminated(documents, items, doc_id, text).where(F.size("spans") > 0).select(F.col(doc_id).alias("_hit"))
    return documents.join(hit, documents[doc_id].eqNullSafe(hit["_hit"]), "left_anti")


