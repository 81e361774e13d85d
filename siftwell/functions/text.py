"""Text expressions (Column -> Column), all JVM-side."""

from __future__ import annotations

import re

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.bind import let

# The white space that a feed's own trim removes.
SPACE = r"[\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"

SPACE_CHARS = (
    "\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# Word boundaries count ASCII word characters only.
WORD_START = r"(?<![A-Za-z0-9_])"
WORD_END = r"(?![A-Za-z0-9_])"

# Phrases that say nothing about the role, in order of removal.
NOISE_PHRASES = [
    "remote", "fully remote", "work from home", "wfh", "contract", "contractor", "freelance", "b2b",
    "full time", "full-time", "part time", "m/f/d", "m/w/d", "f/m/d", "h/f", "all genders",
]

# Legal forms dropped from company names.
LEGAL_FORMS = r"gmbh|ltd|limited|inc|llc|b\.?v\.?|s\.?a\.?|ag|oy|ab"

# HTML entities decoded, in this order, without their ampersand.
ENTITIES = [
    ("nbsp;", " "),
    ("amp;", "&"),
    ("lt;", "<"),
    ("gt;", ">"),
    ("#39;|rsquo;", "'"),
    ("quot;|ldquo;|rdquo;", '"'),
]

# Longest description kept, and the mark put after a cut.
MAX_DESCRIPTION_CHARS = 6000
CUT_MARK = "\n[truncated]"


def trim_space(c: Column) -> Column:
    """Trim every kind of white space, not only U+0020."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def is_blank(c: Column) -> Column:
    """True for NULL and for text of white space only."""
    return F.coalesce(~c.rlike(rf"[^{SPACE[1:-1]}]"), F.lit(True))


def pick_string(*candidates: Column) -> Column:
    """First candidate that is not blank, untrimmed; otherwise the empty string."""
    return F.coalesce(*[F.when(~is_blank(c), c) for c in candidates], F.lit(""))


def join_parts(parts: list[Column], sep: str = " / ") -> Column:
    """Join the parts that are not blank."""
    kept = [F.when(~is_blank(p), p) for p in parts]
    return F.concat_ws(sep, *kept)


# Every pattern begins with one character, which is all that is tried at most places of a text, and
# matches only what changes.
def _untag(t: Column) -> Column:
    out = F.regexp_replace(t, rf"<(?i:br{SPACE}*/?>|/(?:p|div|li|h[1-6])>)", "\n")
    return F.when(F.contains(t, F.lit("<")), F.regexp_replace(out, r"<[^>]*>", " ")).otherwise(t)


def _decode(t: Column) -> Column:
    out = t
    for entity, char in ENTITIES:
        out = F.regexp_replace(out, f"&(?i:{entity})", char)
    return F.when(F.contains(t, F.lit("&")), out).otherwise(t)


def _blanks(t: Column) -> Column:
    return F.regexp_replace(t, r"[ \t](?:(?<=\t)[ \t]*|[ \t]+)", " ")


def _squeeze(t: Column) -> Column:
    out = F.regexp_replace(F.regexp_replace(t, r"[ \n](?:(?<=\n) +|(?<= ) *\n *)", "\n"), r"\n{3,}", "\n\n")
    return trim_space(F.when(F.contains(t, F.lit("\n")), out).otherwise(t))


# Markup to plain text. Tags go before entities, so escaped markup stays as text. Each group of
# passes runs only over text that holds the character it is about.
_PLAIN_STEPS = [_untag, _decode, _blanks, _squeeze]


def strip_html(c: Column) -> Column:
    """Markup to plain text."""
    return reduce(let, _PLAIN_STEPS, c)


def with_plain_text(df: DataFrame, *names: str, limit: int | None = None) -> DataFrame:
    """Columns with markup as plain text, cut after ``limit`` characters if one is given.

    The same steps as :func:`strip_html`, one projection each: ``let`` is interpreted for every
    row, projections are compiled.
    """
    steps = [*_PLAIN_STEPS, *([] if limit is None else [lambda t: cut(t, limit)])]
    return reduce(lambda d, step: d.withColumns({n: step(F.col(n)) for n in names}), steps, df)


def cut(t: Column, limit: int) -> Column:
    """:func:`truncate` for a column."""
    return F.when(F.length(t) > limit, F.concat(F.substring(t, 1, limit), F.lit(CUT_MARK))).otherwise(t)


def truncate(c: Column, limit: int) -> Column:
    return let(c, lambda t: cut(t, limit))


def pick_description(*candidates: Column) -> Column:
    """First non-blank candidate as plain text of bounded width."""
    return truncate(strip_html(pick_string(*candidates)), MAX_DESCRIPTION_CHARS)


def _live_phrases() -> list[str]:
    """Phrases that can still match when their turn comes.

    A phrase holding an earlier phrase as a whole word has been broken by then, and one
    with a character that the separator pass blanks can never occur.
    """
    live: list[str] = []
    for phrase in NOISE_PHRASES:
        broken = any(re.search(rf"\b{re.escape(p)}\b", phrase) for p in live)
        if not broken and re.fullmatch(r"[a-z0-9+#. ]+", phrase):
            live.append(phrase)
    return live


def normalise_title(c: Column) -> Column:
    """Reduce a title to the core that cross-posted copies share.

    Removing a phrase leaves at least two blanks, so no removal can create another
    match and a single alternation gives what phrase-by-phrase passes give.
    """
    out = F.lower(F.coalesce(c, F.lit("")))
    out = F.regexp_replace(out, r"\([^)]*\)", " ")
    out = F.regexp_replace(out, r"\[[^\]]*\]", " ")
    out = F.regexp_replace(out, rf"{WORD_START}[mfhw](?:{SPACE}*/{SPACE}*[mfhwdx])+{WORD_END}", " ")
    out = F.regexp_replace(out, r"[–—|/,:]+", " ")
    out = F.regexp_replace(out, r"[^a-z0-9+#. ]", " ")
    phrases = "|".join(p.replace(".", r"\.") for p in _live_phrases())
    out = F.regexp_replace(out, rf"{WORD_START}(?:{phrases}){WORD_END}", " ")
    return F.trim(F.regexp_replace(out, r" +", " "))


def normalise_company(c: Column) -> Column:
    out = F.lower(F.coalesce(c, F.lit("")))
    out = F.regexp_replace(out, rf"{WORD_START}(?:{LEGAL_FORMS}){ASCII_EDGE}", " ")
    return F.trim(F.regexp_replace(out, r"[^a-z0-9]+", " "))


# A boundary after a form that may itself end in a dot: one side is a word character.
ASCII_EDGE = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"


def company_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^a-z0-9]", "")


def slug(c: Column, limit: int = 60) -> Column:
    dashed = F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-")
    return F.substring(F.regexp_replace(dashed, r"^-|-\z", ""), 1, limit)


def before_first_colon(c: Column) -> Column:
    """Company half of ``Company: Title``; empty without a colon."""
    at = F.instr(c, ":")
    return F.when(at > 0, trim_space(c.substr(F.lit(1), at - 1))).otherwise(F.lit(""))


def after_first_colon(c: Column) -> Column:
    """Title half of ``Company: Title``; the whole text without a colon."""
    at = F.instr(c, ":")
    return trim_space(F.when(at > 0, c.substr(at + 1, F.length(c))).otherwise(c))


def golden_id(url: Column, company: Column, title: Column) -> Column:
    """Stable id from the url, or from company and title where there is no url."""
    basis = F.when(F.coalesce(url, F.lit("")) != "", url).otherwise(F.concat(company, F.lit("|"), title))
    return F.substring(F.sha1(basis), 1, 12)


def pick_option(options: Column, wanted: Column) -> Column:
    """Loosest of four ways to match an offered option: equal, prefix, part, contained."""
    w = F.lower(trim_space(wanted))

    def first(test) -> Column:
        return F.get(F.filter(options, test), F.lit(0))

    found = F.coalesce(
        first(lambda o: F.lower(trim_space(o)) == w),
        first(lambda o: F.startswith(F.lower(o), w)),
        first(lambda o: F.contains(F.lower(o), w)),
        first(lambda o: F.contains(w, F.lower(trim_space(o))) & (F.length(trim_space(o)) > 2)),
    )
    return F.when(w != "", found)


def format_pct(c: Column) -> Column:
    return F.format_string("%.1f%%", c * 100.0)
