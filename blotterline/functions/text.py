"""Expressions over raw text fields.

External text never raises under ANSI mode: what cannot be read becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotterline.schema import TRUE_TEXT, UNKNOWN_CATEGORY


def is_blank(text: Column) -> Column:
    """True for null and for text of blanks only."""
    return text.isNull() | (F.trim(text) == "")


def or_unknown(text: Column) -> Column:
    """Blank categories become ``UNKNOWN``; others stay as they are, untrimmed."""
    return F.when(is_blank(text), F.lit(UNKNOWN_CATEGORY)).otherwise(text)


def flag(text: Column) -> Column:
    """True for exactly ``true``, false for all else; never null."""
    return text.eqNullSafe(TRUE_TEXT)


def to_number(text: Column) -> Column:
    """Text as double, null when it is no number. Surrounding blanks are accepted.

    Decimal notation with or without exponent. ``NaN`` and ``Infinity`` give those values, but
    Java's type suffixes (``41.8f``) are no part of a number.
    """
    return F.when(~F.rlike(text, F.lit(r"[fFdD]\s*$")), text.try_cast("double"))


def percent_bucket(key: Column) -> Column:
    """A bucket 0..99 that depends on the key's text alone, in any engine with md5."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
