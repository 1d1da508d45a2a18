"""Arithmetic expressions with the null rules the reports need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_upper(value: Column, limit: int) -> Column:
    """Value cut at ``limit``; a null stays null (``least`` would turn it into the limit)."""
    return F.when(value > limit, F.lit(limit)).otherwise(value)


def count_if(condition: Column) -> Column:
    """How many rows of a group meet a condition; a null condition does not count."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with one decimal, as a double."""
    return F.round(F.lit(100.0) * part / whole, 1)


def mean_from_sums(total: Column, count: Column, digits: int) -> Column:
    """Rounded mean of values that were already summed and counted; null for no values."""
    return F.round(F.when(count > 0, total / count), digits)


def weighted_sum(value: str) -> Column:
    """Sum of a column in which each row counts ``weight`` times."""
    return F.sum(F.col(value) * F.col("weight"))


def weighted_mean(value: str) -> Column:
    """Mean of a column in which each row counts ``weight`` times; nulls do not count."""
    return weighted_sum(value) / F.sum(F.when(F.col(value).isNotNull(), F.col("weight")))
