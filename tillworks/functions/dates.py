"""Dates without a zone: what the clock on the wall showed when the invoice was written."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings besides year-month-day. Dates with slashes have the month first, as
# spreadsheet exports write them; two-digit years up to 68 are of this century.
SLASH_DATE = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})(.*)$"
SHORT_YEAR = r"^\s*(\d{1,2})/(\d{1,2})/(\d{2})(\s.*)?$"
NAMED_MONTH = r"^\s*(\d{1,2})[- ]([A-Za-z]{3})[A-Za-z]*[- ](\d{4})(.*)$"
DIGITS_ONLY = r"^\s*(\d{4})(\d{2})(\d{2})(\s.*)?$"
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def to_moment(value: Column) -> Column:
    """Text to timestamp; null when it is not a date."""
    century = F.when(F.regexp_extract(value, SHORT_YEAR, 3) <= "68", "20").otherwise("19")
    short = F.concat(
        century, F.regexp_extract(value, SHORT_YEAR, 3), F.lit("-"), F.regexp_extract(value, SHORT_YEAR, 1), F.lit("-"),
        F.regexp_extract(value, SHORT_YEAR, 2), F.regexp_extract(value, SHORT_YEAR, 4),
    )
    month = F.position(F.lower(F.regexp_extract(value, NAMED_MONTH, 2)), F.lit(MONTHS))
    named = F.when(month % 3 == 1, F.concat(
        F.regexp_extract(value, NAMED_MONTH, 3), F.lit("-"), ((month + 2) / 3).cast("int").cast("string"), F.lit("-"),
        F.regexp_extract(value, NAMED_MONTH, 1), F.regexp_extract(value, NAMED_MONTH, 4),
    ))
    iso = (
        F.when(F.substring(value, 5, 1) == "-", value)
        .when(value.contains("/"), F.when(value.rlike(SHORT_YEAR), short).otherwise(F.regexp_replace(value, SLASH_DATE, "$3-$1-$2$4")))
        .when(value.rlike(NAMED_MONTH), named)
        .when(value.rlike(DIGITS_ONLY), F.regexp_replace(value, DIGITS_ONLY, "$1-$2-$3$4"))
        .otherwise(value)
    )
    return iso.try_cast("timestamp_ntz")


def period_start(unit: str, moment: Column) -> Column:
    """First moment of the day, week (Monday), month or quarter."""
    return F.date_trunc(unit, moment).cast("timestamp_ntz")


def moment(text: str) -> Column:
    """A literal timestamp without a zone."""
    return F.lit(text).cast("timestamp_ntz")
