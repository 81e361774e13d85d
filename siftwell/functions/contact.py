"""Addresses that a posting asks applicants to write to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftwell.functions.text import WORD_END, WORD_START

# Address shape, mailboxes that never take applications, words that ask for one,
# and how much text around the address counts.
ADDRESS = r"(?i)([A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,})"
ROLE_MAILBOX = r"(?i)^(no-?reply|privacy|support|info|security|abuse|legal|press|dpo|gdpr)@"
ASKING_WORDS = ["apply", "application", "send", "cv", "resume", "portfolio", "reach out", "email us", "write to"]
BEFORE, AFTER = 160, 40

# "résumé" ends in a letter that is no ASCII word character, so its closing boundary
# asks for a word character to follow.
_ASKS = rf"{WORD_START}(?:(?:{'|'.join(ASKING_WORDS)}){WORD_END}|résumé(?=[A-Za-z0-9_]))"


def extract_apply_email(text: Column) -> Column:
    """First address that is no role mailbox and has an application word near it.

    The matches are walked left to right with a cursor, which finds each match at the
    position the pattern found it: between two matches the earlier text holds none.
    """
    found = F.regexp_extract_all(text, F.lit(ADDRESS), F.lit(1))
    start = F.struct(F.lit(1).alias("at"), F.lit(None).cast("string").alias("hit"))

    def step(state: Column, address: Column) -> Column:
        pos = F.position(address, text, state["at"])
        first = F.greatest(pos - BEFORE, F.lit(1))
        around = F.lower(F.substring(text, first, pos + F.length(address) + AFTER - first))
        good = ~address.rlike(ROLE_MAILBOX) & around.rlike(_ASKS)
        return F.struct(
            (pos + F.length(address)).alias("at"),
            F.coalesce(state["hit"], F.when(good, address)).alias("hit"),
        )

    return F.when(F.contains(text, F.lit("@")), F.aggregate(found, start, step)["hit"])
