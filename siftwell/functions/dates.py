"""Dates arrive as ISO text, RFC-822 text, epoch seconds or epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftwell.functions.bind import let
from siftwell.functions.text import trim_space

DAY_MICROS = 86_400_000_000

# Zone names that mail-style dates carry.
ZONES = {
    "GMT": "+0000", "UTC": "+0000", "UT": "+0000", "Z": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}

# Above this a number counts milliseconds; beyond the second bound it is no date.
MILLIS_FROM = 1e12
LAST_MILLI = 8.64e15


def number_to_timestamp(c: Column) -> Column:
    """Epoch milliseconds above the threshold, epoch seconds otherwise."""
    n = c.cast("double")
    millis = F.when(n > MILLIS_FROM, n).otherwise(n * 1000.0)
    whole = F.when(millis >= 0, F.floor(millis)).otherwise(F.ceil(millis))
    return F.when(F.abs(millis) <= LAST_MILLI, F.timestamp_millis(whole))


def _mail_date(c: Column) -> Column:
    shape = (
        r"^(?:[A-Za-z]{3,9},?\s+)?(\d{1,2})\s+([A-Za-z]{3})[a-z]*\s+(\d{4})"
        r"(?:\s+(\d{1,2}:\d{2})(:\d{2})?)?\s*([A-Za-z]{1,3}|[+-]\d{2}:?\d{2})?$"
    )

    def part(i: int) -> Column:
        return F.regexp_extract(c, shape, i)

    zone = F.upper(F.replace(part(6), F.lit(":"), F.lit("")))
    names = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    offset = F.when(zone == "", F.lit("+0000")).when(zone.rlike(r"^[+-]"), zone).otherwise(F.get(F.array(names[zone]), F.lit(0)))
    clock = F.when(part(4) == "", F.lit("00:00")).otherwise(part(4))
    seconds = F.when(part(5) == "", F.lit(":00")).otherwise(part(5))
    text = F.concat_ws(" ", part(1), F.initcap(part(2)), part(3), F.concat(clock, seconds), offset)
    return F.when(c.rlike(shape) & offset.isNotNull(), F.try_to_timestamp(text, F.lit("d MMM yyyy H:mm:ss Z")))


def text_to_timestamp(c: Column) -> Column:
    """Text rule: plain numbers are epochs, then ISO, then mail dates; the rest is NULL."""
    return let(trim_space(c), trimmed_to_timestamp)


def trimmed_to_timestamp(t: Column) -> Column:
    """The text rule for a column of trimmed text."""
    iso = F.when(t.rlike(r"^\d{4}(?:-\d{1,2}){1,2}(?:[T ]|$)"), t.try_cast("timestamp"))
    number = number_to_timestamp(t.try_cast("double"))
    plain = t.rlike(r"^\+?(?:\d+\.?\d*|\.\d+)(?:[eE]\+?\d+)?$")
    # A text that is no date of one kind may be one of the next.
    return F.coalesce(iso, F.when(plain, number), _mail_date(t))


def to_iso_date(c: Column) -> Column:
    """Timestamp as ISO text in UTC with milliseconds; NULL becomes the empty string."""
    return F.coalesce(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), F.lit(""))


def first_seen_stamp(now: Column) -> Column:
    return F.to_date(now)


def age_in_days(first_seen: Column, now: Column) -> Column:
    """Whole days between the first sighting and now; NULL when never seen."""
    gap = F.unix_micros(now.cast("timestamp")) - F.unix_micros(first_seen.cast("timestamp"))
    return F.floor(gap / F.lit(DAY_MICROS)).cast("long")


def older_than(moment: Column, now: Column, days: float) -> Column:
    """Strictly older than ``days``; an unknown moment is not older than anything."""
    gap = F.unix_micros(now.cast("timestamp")) - F.unix_micros(moment.cast("timestamp"))
    return F.coalesce(gap > F.lit(int(days * DAY_MICROS)), F.lit(False))


def younger_than(moment: Column, now: Column, days: float) -> Column:
    gap = F.unix_micros(now.cast("timestamp")) - F.unix_micros(moment.cast("timestamp"))
    return F.coalesce(gap < F.lit(int(days * DAY_MICROS)), F.lit(False))
