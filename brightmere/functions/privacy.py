"""Masking of personal data in text."""

from __future__ import annotations

from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK = "<ANONYMIZED>"

# Applied in this order: an address inside a link is masked with the link, and long
# digit groups (cards, account numbers) go before the shorter phone numbers.
PATTERNS = {
    "url": r"(?i)(?:https?|ftp)://[^\s<>]+",
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?",
    "card": r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}",
    "ip": r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}",
    "national_id": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-][0-9]{2,4}){2,4}",
}


# What a text must hold for a pattern to match at all: a literal, or a digit. Texts without
# it, most of them, skip the pattern.
DIGIT = "[0-9]"
NEEDS = {
    "url": "://",
    "email": "@",
    "iban": DIGIT,
    "card": DIGIT,
    "ip": DIGIT,
    "national_id": DIGIT,
    "phone": DIGIT,
}


def masked(text: Column, replacement: str = MASK, patterns: dict[str, str] = PATTERNS) -> Column:
    """``text`` with every match of every pattern replaced; NULL stays NULL."""
    done = text
    for need, group in groupby(patterns.items(), key=lambda item: NEEDS.get(item[0])):
        replaced = reduce(
            lambda t, item: F.regexp_replace(t, item[1], replacement), group, done
        )
        if need is None:
            done = replaced
        else:
            holds = F.regexp_like(text, F.lit(DIGIT)) if need == DIGIT else F.contains(text, F.lit(need))
            done = F.when(holds, replaced).otherwise(done)
    return done


def anonymize(
    df: DataFrame, col: str, replacement: str = MASK, patterns: dict[str, str] = PATTERNS
) -> DataFrame:
    """Mask e-mail and web addresses, phone, card and account numbers in ``col``."""
    return df.withColumn(col, masked(F.col(col), replacement, patterns))


def leaks(text: Column, patterns: dict[str, str] = PATTERNS) -> Column:
    """How many patterns still match ``text``."""
    return reduce(
        lambda total, pattern: total + F.coalesce(F.regexp_like(text, F.lit(pattern)).cast("int"), F.lit(0)),
        patterns.values(),
        F.lit(0),
    )
