"""URL allow and block rules on host suffixes and path prefixes.

Every url is expanded into the expressions a rule could be written as: each suffix of its host at
a label border, followed by each prefix of its path that is as long as some rule's path. The
SHA-256 digest of an expression is compared with the rules' digests in two steps: an equi-join on
the first four bytes, then equality of the whole digest. Of the rules that fit, the longest wins;
of equally long ones the one with the longer host, then ``block`` before ``allow``.

Cases: a null url, or one without ``://``, has an empty host and path and gets the default
verdict. An empty path fits only rules whose path is empty. Rules with a null host, path or
verdict are ignored; repeated ones count once. Rows come back as often as they came in. Columns of
``pages`` other than the url are passed through, unless they carry one of the four result names;
such a column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.asciicase import lower_ascii

DEFAULT_VERDICT = "allow"
# Rules are broadcast up to this many; beyond it the join shuffles.
BROADCAST_RULES = 200_000
SHORT_HEX = 8


def host_of(url: Column) -> Column:
    """Lower-case authority of a url, empty when there is none."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """Path of a url up to ``?`` or ``#``, empty when there is none."""
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def expressions(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """Host suffixes times path prefixes, as one array of texts."""
    labels = F.split(host, r"\.")
    count = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(labels, i, count), ".")
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in path_lengths]),
        lambda p: p.isNotNull(),
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def _prepared(rules: DataFrame) -> DataFrame:
    text = F.concat(F.col("host"), F.col("path"))
    known = rules.select(
        lower_ascii(F.col("host").cast("string")).alias("host"),
        F.col("path").cast("string").alias("path"),
        F.col("verdict").cast("string").alias("verdict"),
    ).where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
    return known.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(
        text.alias("rule"),
        F.length("host").alias("host_length"),
        F.length("path").alias("path_length"),
        "verdict",
        F.sha2(text, 256).alias("digest"),
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT_VERDICT
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has host, path and verdict (``allow`` or ``block``).
    """
    table = _prepared(rules)
    # One row per length of a rule's path: bounded by the longest rule, whatever the tables hold.
    seen = table.groupBy("path_length").agg(F.count(F.lit(1)).alias("rules")).orderBy("path_length").collect()
    lengths = [r["path_length"] for r in seen]
    base = pages.drop("host", "path", "rule", "verdict")
    parsed = base.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if not lengths:
        return parsed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})

    distinct = (
        pages.select(F.col(url).alias("_url")).where(F.col("_url").contains("://")).distinct()
    )
    spread = distinct.select(
        "_url", F.explode(expressions(host_of(F.col("_url")), path_of(F.col("_url")), lengths)).alias("expression")
    ).withColumn("full", F.sha2("expression", 256))
    keyed = table.withColumn("short", F.substring("digest", 1, SHORT_HEX))
    if sum(r["rules"] for r in seen) <= BROADCAST_RULES:
        keyed = F.broadcast(keyed)
    hits = spread.withColumn("short", F.substring("full", 1, SHORT_HEX)).join(keyed, "short")
    best = (
        hits.where(F.col("full") == F.col("digest"))
        .groupBy("_url")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "host_length", "verdict", "rule")).alias("best"))
        .select("_url", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    )
    joined = parsed.join(best, parsed[url] == best["_url"], "left").drop("_url")
    return joined.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
