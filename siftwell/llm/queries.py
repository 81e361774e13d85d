"""One query per operator over its whole table, with comparison SQL where SQL can express it."""

from __future__ import annotations


import public_tokenizers
from pyspark.sql import functions as F

from siftwell.llm import bitslices, bytenet, maintext, packing, repeats, secrets, simhash, suffixes, tokencount, toxicity, urlrules, whitening, winnowing
from siftwell.llm.registry import ORACLES, QUERIES, query, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def held_out(doc_id: str = "doc_id"):
    """Rows that no model learns from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def held_out_quality(doc_id: str = "doc_id"):
    """Rows that the quality classifier does not learn from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


@query("op1_html_extraction")
def op1_html_extraction(spark, sf_dir):
    """Main text of every page."""
    pages = maintext.extract(table(spark, sf_dir, "pages"), maintext.train(spark))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query(
    "op2_exact_topk_search",
    """WITH n AS (SELECT vec_id, embedding AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT vec_id, list_transform(e, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q FROM n),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)
SELECT * FROM (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
  AS rank, vec_id, score FROM s) WHERE rank <= 20""",
)
def op2_exact_topk_search(spark, sf_dir):
    """The 20 best rows for every row whose id is divisible by 20."""
    return bitslices.exact_top(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    documents = table(spark, sf_dir, "documents")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"), learn=~held_out())
    return toxicity.score(documents, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


@query("op4_packing")
def op4_packing(spark, sf_dir):
    """Pieces of all documents in windows of 2048 tokens."""
    packed = packing.pack(table(spark, sf_dir, "documents"), VOCABULARY, PATTERN)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op5_secret_scans")
def op5_secret_scans(spark, sf_dir):
    """Every candidate in every document with the forest's vote."""
    forest = secrets.train(secrets.labelled_findings(spark))
    found = secrets.findings(table(spark, sf_dir, "documents"), forest)
    return found.select("doc_id", "start", "length", F.sha2("value", 256).alias("value_sha256"), "score", "secret")


@query("op6_suffix_array_dedup")
def op6_suffix_array_dedup(spark, sf_dir):
    """What is left of every document without strings of 50 bytes that an earlier one holds."""
    found = suffixes.without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op7_simhash_near_dedup")
def op7_simhash_near_dedup(spark, sf_dir):
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_token_counts")
def op8_token_counts(spark, sf_dir):
    """Greedy longest-match tokens of every document."""
    entries = tokencount.read_vocabulary(VOCABULARY)
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), entries)


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query(
    "op9_url_filters",
    """WITH rules(rh, rp, rv) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest AS (SELECT page_id, url, CASE WHEN url IS NOT NULL AND strpos(url, '://') > 0
  THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, regexp_extract(r, '^[^/?#]*') AS raw_host, r FROM rest),
parsed AS (SELECT row_number() OVER () AS k, page_id,
  translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(r, length(raw_host) + 1), '^[^?#]*') AS path FROM parts),
fits AS (SELECT k, rh || rp AS rule, rv,
  row_number() OVER (PARTITION BY k ORDER BY length(rh || rp) DESC, length(rh) DESC, rv DESC) AS place
  FROM parsed JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict
FROM parsed LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (k)""",
)
def op9_url_filters(spark, sf_dir):
    """Verdict of every page's url under the fixed rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict"
    )


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(
    "op10_benchmark_decontamination",
    f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
    array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wins),
spots AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
grams AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram FROM spots),
found AS (SELECT doc_id, item_id, i, n FROM grams JOIN wins USING (n, gram)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)""",
)
def op10_benchmark_decontamination(spark, sf_dir):
    """Words of every document that lie in a benchmark window."""
    return winnowing.digest(
        winnowing.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    )


@query("op11_periodic_run_detection")
def op11_periodic_run_detection(spark, sf_dir):
    """Periodic runs of words in every document, and digests of what is left without repeats."""
    return repeats.digest(repeats.find_runs(table(spark, sf_dir, "documents"), rewrite=repeats.echoing))


@query("op12_quality_classifier")
def op12_quality_classifier(spark, sf_dir):
    """Quality score of every document."""
    documents = table(spark, sf_dir, "documents")
    model = bytenet.train(documents, table(spark, sf_dir, "labels"), learn=~held_out_quality())
    return bytenet.score(documents, model).select(
        "doc_id",
        held_out_quality().alias("held_out"),
        "score",
        F.when(F.col("score") >= bytenet.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark, sf_dir):
    """The 32 strongest components of every embedding, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


__all__ = ["ORACLES", "QUERIES"]
