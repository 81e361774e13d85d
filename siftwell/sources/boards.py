"""Company boards: landed documents of one company's applicant-tracking system to postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.dates import trimmed_to_timestamp
from siftwell.functions.text import MAX_DESCRIPTION_CHARS, join_parts, pick_string, trim_space, with_plain_text
from siftwell.sources.payloads import (
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
    valid,
)
from siftwell.operators.unnest import unnest
from siftwell.schema import SOURCE_ORDER


def _rank(source: str) -> int:
    return SOURCE_ORDER.index(source)


def from_greenhouse(bronze: DataFrame) -> DataFrame:
    rows = explode_list(
        bronze,
        "greenhouse",
        "jobs",
        {
            "title": ("title", as_text),
            "place": ("location.name", as_text),
            "link": ("absolute_url", as_text),
            "content": ("content", as_text),
            **dates("updated_at", "first_published"),
        },
    )
    return valid(
        as_postings(
            rows,
            "greenhouse",
            _rank("greenhouse"),
            company=F.col("company"),
            title=pick_string(F.col("title")),
            location=pick_string(F.col("place")),
            url=pick_string(F.col("link")),
            posted_at=moment(),
            description=pick_string(F.col("content")),
        )
    )


def from_lever(bronze: DataFrame) -> DataFrame:
    rows = explode_list(
        bronze,
        "lever",
        None,
        {
            "title": ("text", as_text),
            "place": ("categories.location", as_scalar),
            "workplace": ("workplaceType", as_scalar),
            "hosted": ("hostedUrl", as_text),
            "apply": ("applyUrl", as_text),
            "plain": ("descriptionPlain", as_text),
            "html": ("description", as_text),
            **dates("createdAt"),
        },
    )
    return valid(
        as_postings(
            rows,
            "lever",
            _rank("lever"),
            company=F.col("company"),
            title=pick_string(F.col("title")),
            location=join_parts([F.col("place"), F.col("workplace")]),
            url=pick_string(F.col("hosted"), F.col("apply")),
            posted_at=moment(),
            description=pick_string(F.col("plain"), F.col("html")),
        )
    )


def from_ashby(bronze: DataFrame) -> DataFrame:
    rows = explode_list(
        bronze,
        "ashby",
        "jobs",
        {
            "title": ("title", as_text),
            "place": ("location", as_scalar),
            "is_remote": ("isRemote", is_truthy),
            "link": ("jobUrl", as_text),
            "apply": ("applyUrl", as_text),
            "pay": ("compensation.compensationTierSummary", as_text),
            "plain": ("descriptionPlain", as_text),
            "html": ("descriptionHtml", as_text),
            **dates("publishedAt"),
        },
    )
    return valid(
        as_postings(
            rows,
            "ashby",
            _rank("ashby"),
            company=F.col("company"),
            title=pick_string(F.col("title")),
            location=join_parts([F.col("place"), remote("is_remote")]),
            url=pick_string(F.col("link"), F.col("apply")),
            posted_at=moment(),
            salary=not_blank(F.col("pay")),
            description=pick_string(F.col("plain"), F.col("html")),
        )
    )


def from_workable(bronze: DataFrame) -> DataFrame:
    rows = explode_list(
        bronze,
        "workable",
        "jobs",
        {
            "title": ("title", as_text),
            "city": ("city", as_scalar),
            "country": ("country", as_scalar),
            "is_remote": ("telecommuting", is_truthy),
            "link": ("url", as_text),
            "short": ("shortlink", as_text),
            "apply": ("application_url", as_text),
            "html": ("description", as_text),
            "needs": ("requirements", as_text),
            **dates("published_on", "created_at"),
        },
    )
    return valid(
        as_postings(
            rows,
            "workable",
            _rank("workable"),
            company=F.col("company"),
            title=pick_string(F.col("title")),
            location=join_parts([F.col("city"), F.col("country"), remote("is_remote")], ", "),
            url=pick_string(F.col("link"), F.col("short"), F.col("apply")),
            posted_at=moment(),
            description=pick_string(F.col("html"), F.col("needs")),
        )
    )


def from_recruitee(bronze: DataFrame) -> DataFrame:
    rows = explode_list(
        bronze,
        "recruitee",
        "offers",
        {
            "title": ("title", as_text),
            "place": ("location", as_scalar),
            "is_remote": ("remote", is_truthy),
            "link": ("careers_url", as_text),
            "apply": ("careers_apply_url", as_text),
            "html": ("description", as_text),
            "needs": ("requirements", as_text),
            **dates("created_at"),
        },
    )
    return valid(
        as_postings(
            rows,
            "recruitee",
            _rank("recruitee"),
            company=F.col("company"),
            title=pick_string(F.col("title")),
            location=join_parts([F.col("place"), remote("is_remote")]),
            url=pick_string(F.col("link"), F.col("apply")),
            posted_at=moment(),
            description=pick_string(F.col("html"), F.col("needs")),
        )
    )


# Titles worth a detail document, and the posting address.
DETAIL_TITLES = r"(?i)front|react|full.?stack|javascript|typescript|web|next"
SMART_URL = "https://jobs.smartrecruiters.com/"
SECTIONS = "jobAd struct<sections map<string, struct<title string, text string>>>"


def detail_texts(details: DataFrame) -> DataFrame:
    """Plain text per key of a detail document (``company, id, payload``): its sections in document order.

    Texts are grouped by the key that postings are joined on, so they are shuffled once.
    """
    sections = F.map_values(F.from_json("payload", SECTIONS)["jobAd"]["sections"])
    blank = F.lit("")
    joined = F.array_join(
        F.transform(
            sections, lambda s: F.concat(F.coalesce(s["title"], blank), F.lit("\n"), F.coalesce(s["text"], blank))
        ),
        "\n",
    )
    texts = details.select(detail_key().alias("_key"), pick_string(joined).alias("detail"))
    texts = with_plain_text(texts, "detail", limit=MAX_DESCRIPTION_CHARS)
    # A document that landed twice counts once.
    return texts.groupBy("_key").agg(F.max("detail").alias("detail"))


def detail_key() -> Column:
    return F.concat_ws("\u0001", "company", "id")


def from_smartrecruiters(bronze: DataFrame, details: DataFrame) -> DataFrame:
    """List documents joined to detail documents, for plausible titles only.

    (company, id) is made unique among the details, so a document landed twice doubles nothing.
    """
    rows = explode_list(
        bronze,
        "smartrecruiters",
        "content",
        {
            "id": ("id", lambda v: F.when(is_truthy(v), as_scalar(v))),
            "title": ("name", lambda v: pick_string(as_text(v))),
            "named": ("company.name", lambda v: pick_string(as_text(v))),
            "city": ("location.city", as_scalar),
            "country": ("location.country", as_text),
            "is_remote": ("location.remote", is_truthy),
            **dates("releasedDate"),
        },
    )
    # Postings that need no detail get a key of their own: it matches nothing and spreads.
    own = F.concat(F.lit("\u0000"), F.col("seq").cast("string"))
    wants = F.col("title").rlike(DETAIL_TITLES) & F.col("id").isNotNull()
    place = join_parts([F.col("city"), F.upper("country"), remote("is_remote")], ", ")
    rows = rows.select(
        "seq", "company", "id", "title", "named", place.alias("place"), moment().alias("moment"),
        F.when(wants, detail_key()).otherwise(own).alias("_key"),
    )
    rows = rows.join(detail_texts(details), "_key", "left")
    named = F.col("named")
    return valid(
        as_postings(
            rows,
            "smartrecruiters",
            _rank("smartrecruiters"),
            company=F.when(named != "", named).otherwise(F.col("company")),
            title=F.col("title"),
            location=F.col("place"),
            url=F.coalesce(F.concat(F.lit(SMART_URL), F.col("company"), F.lit("/"), F.col("id")), F.lit("")),
            posted_at=F.col("moment"),
            markup=(),
            description=F.coalesce("detail", F.lit("")),
        )
    )


PERSONIO = (
    "position array<struct<id string, name string, office string, subcompany string, employmentType string,"
    " createdAt string, additionalOffices struct<office array<string>>,"
    " jobDescriptions struct<jobDescription array<struct<name string, value string>>>>>"
)


def from_personio_xml(bronze: DataFrame) -> DataFrame:
    """One XML feed per company; an array schema makes one position and many look alike."""
    parsed = F.from_xml("payload", PERSONIO, {"ignoreSurroundingSpaces": "true"})
    feeds = documents(bronze, "personio").where(F.col("payload").contains("<workzag-jobs"))
    rows = unnest(feeds, parsed["position"], "_pos", "p")
    rows = rows.select("company", document_seq(F.col("seq"), F.col("_pos")).alias("seq"), "p")
    p = F.col("p")
    blank = F.lit("")

    def given(c):
        return F.when(F.coalesce(c, blank) != "", c)

    offices = F.concat(F.array(p["office"]), F.coalesce(p["additionalOffices"]["office"], F.array().cast("array<string>")))
    parts = F.transform(
        F.coalesce(p["jobDescriptions"]["jobDescription"], F.array().cast("array<struct<name:string,value:string>>")),
        lambda d: F.concat(F.coalesce(d["name"], blank), F.lit("\n"), F.coalesce(d["value"], blank)),
    )
    rows = rows.select("*", pick_string(F.array_join(parts, "\n")).alias("body"), trim_space(p["createdAt"]).alias("created"))
    rows = with_plain_text(rows, "body", limit=MAX_DESCRIPTION_CHARS)
    kind = F.when(F.coalesce(p["employmentType"], blank) != "", F.concat(F.lit("Employment type: "), p["employmentType"]))
    url = F.concat(F.lit("https://"), F.col("company"), F.lit(".jobs.personio.de/job/"), given(p["id"]))
    return valid(
        as_postings(
            rows,
            "personio",
            _rank("personio"),
            company=F.coalesce(given(p["subcompany"]), F.col("company")),
            title=trim_space(F.coalesce(p["name"], blank)),
            location=F.array_join(F.filter(offices, lambda o: o != ""), ", "),
            url=F.coalesce(url, blank),
            posted_at=trimmed_to_timestamp(F.col("created")),
            markup=(),
            description=F.concat_ws("\n", kind, given(F.col("body"))),
        )
    )
