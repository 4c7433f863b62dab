"""Text helpers. All are built-in Column expressions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters with the Unicode White_Space property.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Trim every kind of white space; Spark's plain ``trim`` drops blanks only."""
    return F.trim(c.cast("string"), F.lit(WHITESPACE))


def clean_upper(c: Column) -> Column:
    return F.upper(strip(c))


def trim_set(c: Column, chars: str) -> Column:
    """Trim a set of characters; the empty set leaves the text as it is."""
    return F.trim(c, F.lit(chars)) if chars else c


def is_filled(c: Column) -> Column:
    """Neither null nor the empty string."""
    return c.isNotNull() & (c != "")


def first_digits(c: Column) -> Column:
    """First run of digits as text, null when there is none."""
    return F.regexp_substr(c, F.lit(r"[0-9]+"))


def first_number(c: Column) -> Column:
    return first_digits(c).try_cast("bigint")


def mentions(c: Column, word: str) -> Column:
    """Case-blind search for a plain word."""
    return F.lower(c).contains(word.lower())


def join_key(*cols: Column) -> Column:
    """Concatenate as text without a separator; null if any part is null."""
    return F.concat(*[c.cast("string") for c in cols])


def locale_number(c: Column) -> Column:
    """'1.234,56' to 1234.56; anything unreadable becomes 0."""
    plain = F.replace(F.replace(strip(c), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.coalesce(plain.try_cast("double"), F.lit(0.0))
