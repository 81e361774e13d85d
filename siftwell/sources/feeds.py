"""Whole-board feeds. Their rows are not filtered for a title or a url."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.dates import trimmed_to_timestamp
from siftwell.functions.text import (
    SPACE,
    after_first_colon,
    before_first_colon,
    join_parts,
    pick_string,
    trim_space,
    with_plain_text,
)
from siftwell.sources.payloads import (
    TEXT_LIST,
    Fields,
    as_postings,
    as_scalar,
    as_text,
    dates,
    document_seq,
    documents,
    explode_list,
    is_truthy,
    moment,
    not_blank,
    remote,
)
from siftwell.operators.unnest import unnest
from siftwell.schema import SOURCE_ORDER

ANYWHERE = "Worldwide"


def _rank(source: str) -> int:
    return SOURCE_ORDER.index(source)


def _or_anywhere(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) != "", c).otherwise(F.lit(ANYWHERE))


def _pay_fields(low: str, high: str, currency: str | None = None) -> Fields:
    """The fields that :func:`_pay_range` reads."""
    ends = {
        "low": (low, as_scalar), "has_low": (low, is_truthy),
        "high": (high, as_scalar), "has_high": (high, is_truthy),
    }
    return {**ends, "currency": (currency, as_scalar)} if currency else ends


def _pay_range(currency: bool = False) -> Column:
    """``low-high CUR`` when both ends are given and not zero."""
    low, high = F.col("low"), F.col("high")
    if currency:
        amount = F.trim(F.concat(low, F.lit("-"), high, F.lit(" "), F.coalesce("currency", F.lit(""))))
    else:
        amount = F.concat(F.lit("$"), low, F.lit("-$"), high)
    return F.when(F.col("has_low") & F.col("has_high"), amount)


def from_remotive(bronze: DataFrame) -> DataFrame:
    rows = explode_list(
        bronze,
        "remotive",
        "jobs",
        {
            "employer": ("company_name", as_text),
            "title": ("title", as_text),
            "place": ("candidate_required_location", as_text),
            "link": ("url", as_text),
            "pay": ("salary", as_text),
            "tags": ("tags", TEXT_LIST),
            "html": ("description", as_text),
            **dates("publication_date"),
        },
    )
    return as_postings(
        rows,
        "remotive",
        _rank("remotive"),
        company=pick_string(F.col("employer")),
        title=pick_string(F.col("title")),
        location=pick_string(F.col("place")),
        url=pick_string(F.col("link")),
        posted_at=moment(),
        salary=not_blank(F.col("pay")),
        tags=F.col("tags"),
        description=pick_string(F.col("html")),
    )


def from_remoteok(bronze: DataFrame) -> DataFrame:
    """The feed opens with a notice: elements without an id or a position are no postings."""
    rows = explode_list(
        bronze,
        "remoteok",
        None,
        {
            "has_id": ("id", is_truthy),
            "has_position": ("position", is_truthy),
            "position": ("position", as_text),
            "employer": ("company", as_text),
            "place": ("location", as_text),
            "link": ("url", as_text),
            "apply": ("apply_url", as_text),
            "tags": ("tags", TEXT_LIST),
            "html": ("description", as_text),
            **dates("date"),
            **_pay_fields("salary_min", "salary_max"),
        },
    )
    return as_postings(
        rows.where(F.col("has_id") & F.col("has_position")),
        "remoteok",
        _rank("remoteok"),
        company=pick_string(F.col("employer")),
        title=pick_string(F.col("position")),
        location=_or_anywhere(pick_string(F.col("place"))),
        url=pick_string(F.col("link"), F.col("apply")),
        posted_at=moment(),
        salary=_pay_range(),
        tags=F.col("tags"),
        description=pick_string(F.col("html")),
    )


def from_arbeitnow(bronze: DataFrame) -> DataFrame:
    rows = explode_list(
        bronze,
        "arbeitnow",
        "data",
        {
            "employer": ("company_name", as_text),
            "title": ("title", as_text),
            "place": ("location", as_scalar),
            "is_remote": ("remote", is_truthy),
            "link": ("url", as_text),
            "tags": ("tags", TEXT_LIST),
            "html": ("description", as_text),
            **dates("created_at"),
        },
    )
    return as_postings(
        rows,
        "arbeitnow",
        _rank("arbeitnow"),
        company=pick_string(F.col("employer")),
        title=pick_string(F.col("title")),
        location=join_parts([F.col("place"), remote("is_remote")]),
        url=pick_string(F.col("link")),
        posted_at=moment(),
        tags=F.col("tags"),
        description=pick_string(F.col("html")),
    )


def from_himalayas(bronze: DataFrame) -> DataFrame:
    rows = explode_list(
        bronze,
        "himalayas",
        "jobs",
        {
            "employer": ("companyName", as_text),
            "title": ("title", as_text),
            "places": ("locationRestrictions", TEXT_LIST),
            "link": ("applicationLink", as_text),
            "guid": ("guid", as_text),
            "tags": ("categories", TEXT_LIST),
            "html": ("description", as_text),
            "excerpt": ("excerpt", as_text),
            **dates("pubDate"),
            **_pay_fields("minSalary", "maxSalary", "salaryCurrency"),
        },
    )
    return as_postings(
        rows,
        "himalayas",
        _rank("himalayas"),
        company=pick_string(F.col("employer")),
        title=pick_string(F.col("title")),
        location=_or_anywhere(F.array_join("places", ", ", "")),
        url=pick_string(F.col("link"), F.col("guid")),
        posted_at=moment(),
        salary=_pay_range(currency=True),
        tags=F.col("tags"),
        description=pick_string(F.col("html"), F.col("excerpt")),
    )


def from_jobicy(bronze: DataFrame) -> DataFrame:
    """Titles arrive as HTML."""
    rows = explode_list(
        bronze,
        "jobicy",
        "jobs",
        {
            "employer": ("companyName", as_text),
            "title": ("jobTitle", as_text),
            "place": ("jobGeo", as_text),
            "link": ("url", as_text),
            "tags": ("jobIndustry", TEXT_LIST),
            "html": ("jobDescription", as_text),
            "excerpt": ("jobExcerpt", as_text),
            **dates("pubDate"),
            **_pay_fields("annualSalaryMin", "annualSalaryMax", "salaryCurrency"),
        },
    )
    return as_postings(
        rows,
        "jobicy",
        _rank("jobicy"),
        markup=("title", "description"),
        company=pick_string(F.col("employer")),
        title=pick_string(F.col("title")),
        location=pick_string(F.col("place")),
        url=pick_string(F.col("link")),
        posted_at=moment(),
        salary=_pay_range(currency=True),
        tags=F.col("tags"),
        description=pick_string(F.col("html"), F.col("excerpt")),
    )


RSS = "channel struct<item array<struct<title string, region string, link string, pubDate string, description string>>>"


def from_rss(bronze: DataFrame) -> DataFrame:
    """RSS items titled ``Company: Title``."""
    parsed = F.from_xml("payload", RSS, {"ignoreSurroundingSpaces": "true"})
    feeds = documents(bronze, "weworkremotely").where(F.col("payload").contains("<rss"))
    rows = unnest(feeds, parsed["channel"]["item"], "_pos", "item")
    item, blank = F.col("item"), F.lit("")
    rows = rows.select(
        document_seq(F.col("seq"), F.col("_pos")).alias("seq"),
        "item",
        F.coalesce(item["title"], blank).alias("title"),
        F.coalesce(item["region"], blank).alias("region"),
        trim_space(item["pubDate"]).alias("published"),
    )
    rows = with_plain_text(rows, "region")
    title, region = F.col("title"), F.col("region")
    return as_postings(
        rows,
        "weworkremotely",
        _rank("weworkremotely"),
        company=before_first_colon(title),
        title=after_first_colon(title),
        location=F.when(region != "", region).otherwise(F.lit("Remote")),
        url=F.coalesce(item["link"], blank),
        posted_at=trimmed_to_timestamp(F.col("published")),
        description=pick_string(item["description"]),
    )


# The markup of a card's link, company and location.
CARD_LINK = (
    r'(?s)<a[^>]*class="[^"]*base-card__full-link[^"]*"[^>]*href="([^"]+)"[^>]*>.*?'
    rf'<span class="sr-only">{SPACE}*(.*?){SPACE}*</span>'
)
CARD_COMPANY = r'(?s)<h4[^>]*class="[^"]*base-search-card__subtitle[^"]*"[^>]*>.*?>(.*?)</a>'
CARD_LOCATION = r'(?s)<span[^>]*class="[^"]*job-search-card__location[^"]*"[^>]*>(.*?)</span>'


def from_linkedin_cards(bronze: DataFrame) -> DataFrame:
    """Card pages, read by position: the i-th link goes with the i-th company and location."""
    page = F.col("payload")

    def found(pattern: str, group: int) -> Column:
        return F.regexp_extract_all(page, F.lit(pattern), F.lit(group))

    cards = F.arrays_zip(
        found(CARD_LINK, 1).alias("href"),
        found(CARD_LINK, 2).alias("name"),
        found(CARD_COMPANY, 1).alias("company"),
        found(CARD_LOCATION, 1).alias("place"),
    )
    rows = unnest(documents(bronze, "linkedin"), cards, "_pos", "card")
    # Zipping pads the shorter lists; a company or place without a link is no card.
    rows = rows.where(F.col("card.href").isNotNull())
    rows = rows.select(document_seq(F.col("seq"), F.col("_pos")).alias("seq"), "card.*")
    rows = with_plain_text(rows, "company", "name", "place")
    return as_postings(
        rows,
        "linkedin",
        _rank("linkedin"),
        markup=(),
        company=F.coalesce("company", F.lit("")),
        title=F.col("name"),
        location=F.coalesce("place", F.lit("Remote")),
        url=F.split_part("href", F.lit("?"), F.lit(1)),
    )
