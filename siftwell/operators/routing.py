"""Where an application for a posting goes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.bind import let
from siftwell.functions.contact import extract_apply_email
from siftwell.functions.urls import form_url, url_parts, vendor_of
from siftwell.operators.distinct import top_per_key

# Sites that only link on, sites that forbid automated applications, and reasons.
AGGREGATORS = r"(^|\.)(remoteok\.com|remotive\.com|weworkremotely\.com|himalayas\.app|jobicy\.com|arbeitnow\.com)\z"
NO_BOTS = r"(^|\.)(linkedin\.com|indeed\.[a-z.]+|bayt\.com|gulftalent\.com|glassdoor\.[a-z.]+)\z"
FORBIDDEN_REASON = " does not allow automated applications"
UNSUPPORTED_REASON = "unsupported application site ("
UNRESOLVED_REASON = "could not find where the aggregator sends applications"

ROUTE_FIELDS = ["lane", "ats", "apply_url", "email", "reason"]


def _route(**given: Column) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(*[given.get(f, none).alias(f) for f in ROUTE_FIELDS])


def route(url: Column, company: Column, source: Column, description: Column, try_unknown_sites: bool = False) -> Column:
    """Route struct of a posting. The url is parsed once, and the address search over the
    description is reached only by postings that no earlier rule settles."""

    def decide(u: Column, ats: Column) -> Column:
        host = F.coalesce(u["hostname"], F.lit(""))
        mail = F.split_part(F.substring(url, 8, 1 << 30), F.lit("?"), F.lit(1))
        hint = F.when(source == ats, company)

        def by_text(address: Column) -> Column:
            found = F.when(address.isNotNull(), _route(lane=F.lit("email"), email=address)).when(
                host.rlike(AGGREGATORS), _route(lane=F.lit("resolve"))
            )
            if try_unknown_sites:
                found = found.when(host != "", _route(lane=F.lit("ats"), ats=F.lit("generic"), apply_url=url))
            shown = F.when(host == "", F.lit("no url")).otherwise(host)
            return found.otherwise(_route(lane=F.lit("review"), reason=F.concat(F.lit(UNSUPPORTED_REASON), shown, F.lit(")"))))

        return (
            F.when(F.startswith(url, F.lit("mailto:")), _route(lane=F.lit("email"), email=mail))
            .when(ats.isNotNull(), _route(lane=F.lit("ats"), ats=ats, apply_url=form_url(ats, u, url, hint)))
            .when(host.rlike(NO_BOTS), _route(lane=F.lit("review"), reason=F.concat(host, F.lit(FORBIDDEN_REASON))))
            .otherwise(let(extract_apply_email(F.coalesce(description, F.lit(""))), by_text))
        )

    return let(url_parts(url), lambda u: let(vendor_of(u), lambda ats: decide(u, ats)))


def with_route(postings: DataFrame, try_unknown_sites: bool = False) -> DataFrame:
    """Add ``route``. Needs url, company, source and description."""
    columns = [F.col(c) for c in ("url", "company", "source", "description")]
    return postings.withColumn("route", route(*columns, try_unknown_sites))


def resolve_aggregators(postings: DataFrame, links: DataFrame, order: str = "ord") -> DataFrame:
    """Route aggregator postings by the links found on their landed pages.

    ``links`` has ``order``, ``pos`` and ``link``. The first link, in page order, that leads to a
    known vendor or is a mail address decides; a posting without one goes to review.
    """
    routed = with_route(
        postings.select(order, "company", "source", F.lit("").alias("description"))
        .join(links.select(order, "pos", F.col("link").alias("url")), order)
    )
    usable = routed.where((F.col("route.lane") == "ats") | F.startswith("url", F.lit("mailto:")))
    first = top_per_key(usable, [order], [F.col("pos").asc()]).select(order, F.col("route").alias("_found"))
    lost = _route(lane=F.lit("review"), reason=F.lit(UNRESOLVED_REASON))
    return (
        postings.join(first, order, "left").withColumn("route", F.coalesce("_found", lost)).drop("_found")
    )
