"""Rounding, ratios and means with decimal half-up results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int = 2) -> Column:
    """Half-up rounding in decimal arithmetic, so 1.005 becomes 1.01 also when it arrives as a double."""
    return F.round(value.cast("decimal(38,10)"), digits)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, NULL where whole is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100


def mean(value: Column | str) -> Column:
    """Exact sum over non-null count, as a double."""
    value = F.col(value) if isinstance(value, str) else value
    return ratio(F.sum(value), F.count(value))


def total(value: Column | str) -> Column:
    return rounded(F.sum(value), 2)


def flag(condition: Column) -> Column:
    """1 or 0, NULL where the condition is NULL."""
    return condition.cast("int")


def failures(condition: Column) -> Column:
    """Rows where the condition holds; NULL when it was never decided, so that a check on no data fails."""
    return F.sum(flag(condition))
