"""All sources together: registry, union order, board lists, quarantine."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.operators.distinct import first_per_key
from siftwell.operators.reports import COMPANY_SITES
from siftwell.schema import POSTING_COLUMNS, SOURCE_ORDER, posting_order
from siftwell.sources import boards, feeds, jsonld

Reader = Callable[[DataFrame], DataFrame]

# Sources read from the bronze table alone. Add to it to add a source.
READERS: dict[str, Reader] = {
    "greenhouse": boards.from_greenhouse,
    "lever": boards.from_lever,
    "ashby": boards.from_ashby,
    "workable": boards.from_workable,
    "recruitee": boards.from_recruitee,
    "personio": boards.from_personio_xml,
    "remotive": feeds.from_remotive,
    "remoteok": feeds.from_remoteok,
    "arbeitnow": feeds.from_arbeitnow,
    "himalayas": feeds.from_himalayas,
    "jobicy": feeds.from_jobicy,
    "weworkremotely": feeds.from_rss,
    "linkedin": feeds.from_linkedin_cards,
}

# Sources whose documents are boards of single companies, fetched by slug.
BOARD_SOURCES = ["greenhouse", "lever", "ashby", "workable", "recruitee", "smartrecruiters", "personio"]

XML_SOURCES = {"personio": "workzag-jobs", "weworkremotely": "rss"}
HTML_SOURCES = {"linkedin"}


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """Postings of all sources with their overall order ``ord``.

    The rank of a source, not the order of the union, decides which copy the dedupe keeps.
    """
    ordered = sorted(frames, key=SOURCE_ORDER.index)
    ranked = [
        frames[name].select(*POSTING_COLUMNS).withColumn("source_rank", F.lit(SOURCE_ORDER.index(name)))
        for name in ordered
    ]
    return reduce(DataFrame.unionByName, ranked).withColumn("ord", posting_order(F.col("source_rank"), F.col("seq")))


def source_frames(bronze: DataFrame, details: DataFrame | None = None) -> dict[str, DataFrame]:
    """Postings of every source of the bronze table, which is best partitioned by source."""
    frames = {name: read(bronze) for name, read in READERS.items()}
    if details is None:
        # Postings of a source without landed details stay, with an empty description.
        details = bronze.sparkSession.createDataFrame([], "company string, id string, payload string")
    frames["smartrecruiters"] = boards.from_smartrecruiters(bronze, details)
    return frames


def collect_bronze(bronze: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """Every source of the bronze table, one union."""
    return union_sources(source_frames(bronze, details))


def merge_board_lists(configured: DataFrame, discovered: DataFrame) -> DataFrame:
    """Configured slugs, then discovered ones, each once in first order; empty ones dropped.

    Both have ``vendor``, ``slug`` and ``pos``.
    """
    both = configured.select("vendor", "slug", F.lit(0).alias("part"), "pos").unionByName(
        discovered.select("vendor", "slug", F.lit(1).alias("part"), "pos")
    )
    named = both.where(F.coalesce(F.col("slug"), F.lit("")) != "").withColumn("at", F.struct("part", "pos"))
    return first_per_key(named, ["vendor", "slug"], "at").select("vendor", "slug", "part", "pos")


def board_place(number: Column) -> Column:
    """A plain number as the place of a board in its list."""
    return F.struct(number.cast("bigint").alias("site"), F.lit(0).alias("at"), F.lit(0).alias("pos"))


def only_boards(bronze: DataFrame, wanted: DataFrame) -> DataFrame:
    """Documents of all sources, but of board sources only those of ``wanted`` (``vendor``, ``slug``)."""
    listed = wanted.select(F.col("vendor").alias("source"), F.col("slug").alias("company")).distinct()
    is_board = F.col("source").isin(*BOARD_SOURCES)
    boards = bronze.where(is_board).join(listed, ["source", "company"], "left_semi").select(*bronze.columns)
    return bronze.where(~is_board).unionByName(boards)


def payload_error() -> Column:
    """Why a landed document cannot be read; NULL for one that can."""
    payload = F.col("payload")
    blank = F.coalesce(F.length(F.trim(payload)), F.lit(0)) == 0
    xml = F.lit(None).cast("string")
    for source, root in XML_SOURCES.items():
        # The reader marks what it cannot parse whole; an end tag that is missing means a cut.
        record = F.from_xml(payload, "_corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"})
        error = (
            F.when(~payload.contains(f"<{root}"), F.lit("not the expected XML"))
            .when(~F.rlike(payload, F.lit(rf"</{root}\s*>\s*\z|<{root}[^<>]*/>\s*\z")), F.lit("cut-off XML"))
            .when(record["_corrupt_record"].isNotNull(), F.lit("damaged XML"))
            .otherwise(F.lit(""))
        )
        xml = F.when(F.col("source") == source, error).otherwise(xml)
    # Brackets around the text refuse whatever follows a complete document.
    whole = F.try_parse_json(F.concat(F.lit("["), payload, F.lit("]")))
    return (
        F.when(blank, F.lit("empty payload"))
        .when(F.col("source").isin(*HTML_SOURCES), F.lit(None))
        .when(xml == "", F.lit(None))
        .when(xml.isNotNull(), xml)
        .when(whole.isNull(), F.lit("not valid JSON"))
    )


def quarantine(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable documents, and unreadable ones with ``error``. Bad ones never stop a run."""
    marked = bronze.withColumn("error", payload_error())
    return marked.where(F.col("error").isNull()).drop("error"), marked.where(F.col("error").isNotNull())
