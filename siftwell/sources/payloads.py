"""Reading fields out of vendor documents whose shape may drift.

A document is parsed once to VARIANT. A field counts only if its JSON type is the expected
one, so a number where text should be is skipped, not printed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.bind import let
from siftwell.functions.dates import number_to_timestamp, trimmed_to_timestamp
from siftwell.functions.text import MAX_DESCRIPTION_CHARS, is_blank, trim_space, with_plain_text
from siftwell.operators.unnest import unnest
from siftwell.schema import POSTING_COLUMNS

# Postings of one document are numbered inside this step.
DOCUMENT_STEP = 1_000_000


def field(raw: Column, path: str) -> Column:
    return F.try_variant_get(raw, f"$.{path}", "variant")


def kind(value: Column) -> Column:
    """JSON type of a variant: STRING, BIGINT, DECIMAL(..), DOUBLE, BOOLEAN, VOID, ARRAY<..>, OBJECT<..>."""
    return F.schema_of_variant(value)


def names_number(kind_name: Column) -> Column:
    return kind_name.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(kind_name, F.lit("DECIMAL"))


def is_number(value: Column) -> Column:
    return names_number(kind(value))


def as_text(value: Column) -> Column:
    """The value if it is a JSON string, else NULL."""
    return F.when(kind(value) == "STRING", value.cast("string"))


def one_value(c: Column) -> Column:
    """Variant of a text that is one JSON value and nothing more; NULL otherwise."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    return let(
        F.try_variant_get(wrapped, "$", "array<variant>"), lambda a: F.when(F.size(a) == 1, F.get(a, F.lit(0)))
    )


def number_text(value: Column) -> Column:
    """A number the way it is written in a document, without a trailing fraction of zeros."""
    whole = value.cast("double")
    return F.when(whole == F.floor(whole), F.floor(whole).cast("string")).otherwise(value.cast("string"))


def _scalar(value: Column, k: Column) -> Column:
    return F.when(k.isin("STRING", "BOOLEAN"), value.cast("string")).when(names_number(k), number_text(value))


def as_scalar(value: Column) -> Column:
    """Any scalar as text; NULL for null, objects and arrays."""
    return _scalar(value, kind(value))


def as_number(value: Column) -> Column:
    return F.when(is_number(value), value.cast("double"))


def _holds(value: Column, k: Column) -> Column:
    return (
        F.when(k == "BOOLEAN", value.cast("boolean"))
        .when(k == "STRING", value.cast("string") != "")
        .when(names_number(k), value.cast("double") != 0)
        .otherwise(k != "VOID")
    )


def is_truthy(value: Column) -> Column:
    """Present and neither null, false, 0 nor the empty string."""
    return F.coalesce(F.when(value.isNotNull(), _holds(value, kind(value))), F.lit(False))


# The same for a field of an object that is not taken apart by :func:`explode_list`. These are used
# within lambdas, where the kind must be bound to be computed once.
def text(raw: Column, path: str) -> Column:
    return let(field(raw, path), lambda v: F.when(v.isNotNull(), as_text(v)))


def scalar_text(raw: Column, path: str) -> Column:
    return let(field(raw, path), lambda v: F.when(v.isNotNull(), let(kind(v), lambda k: _scalar(v, k))))


def truthy(raw: Column, path: str) -> Column:
    return let(field(raw, path), lambda v: F.coalesce(F.when(v.isNotNull(), let(kind(v), lambda k: _holds(v, k))), F.lit(False)))


def remote(flag: str) -> Column:
    return F.when(F.col(flag), F.lit("Remote"))


def not_blank(c: Column) -> Column:
    return F.when(~is_blank(c), c)


def documents(bronze: DataFrame, source: str) -> DataFrame:
    return bronze.where(F.col("source") == source)


# Read a field as a list of texts, or NULL if it is no array.
TEXT_LIST = "array<string>"

# Where a field is (the first path that is there and not null), and how its value is read.
Fields = dict[str, tuple[str | tuple[str, ...], Callable[[Column], Column] | str]]


def dates(*paths: str) -> Fields:
    """The fields that :func:`moment` reads."""
    return {"date_number": (paths, as_number), "date_text": (paths, lambda v: trim_space(as_text(v)))}


def moment() -> Column:
    """Timestamp from the first field present, by its JSON type."""
    number = F.col("date_number")
    return F.when(number.isNotNull(), number_to_timestamp(number)).otherwise(trimmed_to_timestamp(F.col("date_text")))


def _type_of(members: dict) -> str:
    inner = ", ".join(f"`{n}`: {_type_of(t) if isinstance(t, dict) else t}" for n, t in members.items())
    return f"struct<{inner}>"


def explode_list(bronze: DataFrame, source: str, path: str | None, fields: Fields) -> DataFrame:
    """One row per list element, with ``company``, ``seq`` and its ``fields``.

    ``path`` names the list inside the document; None means the document is the list. Anything
    that is no list gives no rows. The list is cast once to structs of the fields asked for, so an
    element is not searched again for each of them, and columns made of them are compiled.
    """
    members: dict = {}
    for paths, how in fields.values():
        for one in [paths] if isinstance(paths, str) else paths:
            *above, last = one.split(".")
            inner = members
            for name in above:
                inner = inner.setdefault(name, {})
            inner[last] = how if isinstance(how, str) else "variant"
    parsed = F.try_parse_json(F.col("payload"))
    items = F.try_variant_get(parsed, "$" if path is None else f"$.{path}", f"array<{_type_of(members)}>")
    rows = unnest(documents(bronze, source), items, "_pos", "raw")

    def value(one: str) -> Column:
        return reduce(lambda c, name: c[name], one.split("."), F.col("raw"))

    def read(paths: str | tuple[str, ...], how: Callable[[Column], Column] | str) -> Column:
        if isinstance(paths, str):
            return value(paths) if isinstance(how, str) else how(value(paths))
        return how(F.coalesce(*[F.when(~F.is_variant_null(value(p)), value(p)) for p in paths]))

    columns = [read(*given).alias(name) for name, given in fields.items()]
    return rows.select("company", document_seq(F.col("seq"), F.col("_pos")).alias("seq"), *columns)


def document_seq(seq: Column, pos: Column) -> Column:
    """Order of a posting: arrival of its document, then its place in it."""
    return F.when(pos < DOCUMENT_STEP, seq * DOCUMENT_STEP + pos).otherwise(
        F.raise_error(F.lit("more postings in one document than its order can number"))
    )


def as_postings(rows: DataFrame, source: str, rank: int, markup: tuple[str, ...] = ("description",), **columns: Column) -> DataFrame:
    """Project to the posting schema; columns not given are NULL, those with ``markup`` become plain text of bounded width."""
    defaults = {
        "source": F.lit(source),
        "source_rank": F.lit(rank),
        "seq": F.col("seq"),
        "salary": F.lit(None).cast("string"),
        "tags": F.lit(None).cast("array<string>"),
        "posted_at": F.lit(None).cast("timestamp"),
        "description": F.lit(""),
    }
    postings = rows.select(*[{**defaults, **columns}[c].alias(c) for c in POSTING_COLUMNS])
    return with_plain_text(postings, *markup, limit=MAX_DESCRIPTION_CHARS) if markup else postings


def valid(postings: DataFrame, need_url: bool = True) -> DataFrame:
    """Postings with a title and, where asked, a url."""
    keep = F.col("title") != ""
    return postings.where(keep & (F.col("url") != "") if need_url else keep)
