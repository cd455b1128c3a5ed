"""Text clean-up and the display formats of money, counts and percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillworks import schema as S

# Every character Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

PRINTABLE_ENDS = r"(?s)\A[!-~](.*[!-~])?\z"


def strip(value: Column) -> Column:
    """Drop white space of any kind at both ends (plain ``trim`` drops spaces only).

    Text that starts and ends with printable ASCII has none left once spaces are gone, which is
    quicker to see than it is to look for every kind.
    """
    text = F.trim(value)
    return F.when(text.rlike(PRINTABLE_ENDS), text).otherwise(F.trim(text, F.lit(WHITESPACE)))


def is_missing_word(stripped: Column) -> Column:
    """Null, blank, or one of the words files use for a missing value."""
    return F.coalesce(F.upper(stripped).isin(S.MISSING_TOKENS), F.lit(True))


def _plain(value: Column, places: int) -> Column:
    """Rounded half up with a fixed number of decimals and no thousands separators."""
    return F.round(value, places).cast(f"decimal(38,{places})").cast("string")


def _grouped(value: Column, places: int) -> Column:
    return F.format_number(F.round(value, places).cast(f"decimal(38,{places})"), places)


def money_text(value: Column) -> Column:
    """Pounds: ``£1.25M``, ``£150.0K``, ``£1,250.50`` or ``£45.30``; null reads ``£0.00``."""
    amount = value.cast("decimal(28,2)")
    size = F.abs(amount)
    text = (
        F.when(size >= 1_000_000, F.concat(_plain(size / 1_000_000, 2), F.lit("M")))
        .when(size >= 100_000, F.concat(_plain(size / 1_000, 1), F.lit("K")))
        .when(size >= 1_000, _grouped(size, 2))
        .otherwise(_plain(size, 2))
    )
    return F.coalesce(F.concat(F.when(amount < 0, "-").otherwise(""), F.lit("£"), text), F.lit("£0.00"))


def number_text(value: Column) -> Column:
    """Counts: ``1.25M`` from a million up, else thousands separators; null reads ``0``."""
    number = value.cast("decimal(28,2)")
    size = F.abs(number)
    text = (
        F.when(size >= 1_000_000, F.concat(_plain(size / 1_000_000, 2), F.lit("M")))
        .when(size == F.floor(size), _grouped(size, 0))
        .otherwise(_grouped(size, 2))
    )
    return F.coalesce(F.concat(F.when(number < 0, "-").otherwise(""), text), F.lit("0"))


def percent_text(value: Column, places: int = 1) -> Column:
    """A percentage with a fixed number of decimals; null reads ``0.0%``."""
    return F.coalesce(F.concat(_plain(value.cast("decimal(28,6)"), places), F.lit("%")), F.lit("0.0%"))
