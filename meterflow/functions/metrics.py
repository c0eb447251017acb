"""Count and rate expressions used by the aggregates and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterflow import fixed


def count_when(cond: Column) -> Column:
    """Rows where ``cond`` is true, as BIGINT (the ``sum(when(cond, 1) else 0)`` idiom)."""
    return F.count_if(cond).cast("bigint")


def rate(numerator: str | Column, denominator: str | Column, scale: int = fixed.REJECT_RATE_SCALE) -> Column:
    """``round(n / d, scale)``; NULL when ``d`` is 0 or NULL instead of a division error."""
    n = F.col(numerator) if isinstance(numerator, str) else numerator
    d = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.round(F.try_divide(n.cast("double"), d.cast("double")), scale)


def money_sum(c: str | Column) -> Column:
    """Sum of a double amount rounded to the money scale."""
    return F.round(F.sum(c), fixed.MONEY_SCALE)
