"""Exact half-up rounding for ratios of whole numbers.

Money is summed as DECIMAL and turned into whole cents before dividing, so every rounded
figure is decided by integer arithmetic and comes out the same on any engine. DECIMAL(38,0)
leaves room for sums far beyond BIGINT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(38,0)"


def whole(value: Column | int) -> Column:
    """A whole number in the wide decimal type."""
    return (F.lit(value) if isinstance(value, int) else value).cast(WIDE)


def cents(amount: Column) -> Column:
    """A two-decimal amount as whole cents."""
    return (amount * 100).cast(WIDE)


def half_up(numerator: Column, denominator: Column, places: int) -> Column:
    """``numerator / denominator`` rounded half away from zero; null on a zero denominator.

    Both sides are whole numbers and the denominator is not negative.
    """
    scaled = F.abs(numerator) * whole(2 * 10**places)
    below = F.nullif(whole(denominator), whole(0))
    steps = F.call_function("div", scaled + below, below * whole(2))
    signed = F.when(numerator < 0, -steps).otherwise(steps)
    return signed.cast("double") / F.lit(10.0**places)


def money_ratio(amount: Column, count: Column, places: int = 2) -> Column:
    """A money sum per counted thing (order value, revenue per customer, ...)."""
    return half_up(cents(amount), whole(count) * whole(100), places)


def percent(part: Column, total: Column, places: int = 2) -> Column:
    """``part`` of ``total`` in percent, from whole numbers."""
    return half_up(whole(part) * whole(100), whole(total), places)


def money_percent(part: Column, total: Column, places: int = 2) -> Column:
    """``part`` of ``total`` in percent, from money sums."""
    return percent(cents(part), cents(total), places)


def growth_percent(current: Column, previous: Column, places: int = 2) -> Column:
    """Signed change against a previous whole number; null unless that one is positive."""
    base = F.when(previous > 0, whole(previous))
    return half_up((whole(current) - base) * whole(100), base, places)


def amount_out(amount: Column) -> Column:
    """Money as reports show it: the exact decimal sum, handed out as DOUBLE."""
    return amount.cast("double")
