"""Exact rounding and plain number text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """`round(numerator / denominator, digits)` for whole numbers >= 0, ties away from zero.

    Done in whole numbers, so that no binary fraction can tip a tie. Null for a zero denominator.
    """
    scale = 10**digits
    den = F.nullif(denominator.cast("bigint"), F.lit(0).cast("bigint"))
    num = numerator.cast("bigint")
    units = F.call_function("div", num * (2 * scale) + den, den * 2)
    return units.cast("double") / F.lit(float(scale))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return rounded_ratio(part * 100, whole, digits)


def half_up(c: Column, digits: int = 0) -> Column:
    """Round a double >= 0 half up the way `floor(x * 10^d + 0.5)` does."""
    if digits == 0:
        return F.floor(c + F.lit(0.5))
    scale = F.lit(float(10**digits))
    return F.floor(c * scale + F.lit(0.5)).cast("double") / scale


def number_text(c: Column) -> Column:
    """Double as text without a trailing `.0`."""
    return F.regexp_replace(c.cast("string"), r"\.0$", "")


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true; a null condition counts as false."""
    return F.sum(F.when(condition, 1).otherwise(0)).cast("bigint")
