"""Reproducible pseudo-random draws.

A draw is a hash of (seed, label, row id), so a row gets the same values in any
partitioning and after any task retry. ``rand(seed)`` would depend on both.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_RANGE = 2**32
# Hexadecimal digits of a draw, and of one over a span that may be any table's row count.
DIGITS, WIDE_DIGITS = 8, 15


def draw(seed: int, label: str, row_id: Column, digits: int = DIGITS) -> Column:
    """Integer of the first ``digits`` hexadecimal digits of an md5 over seed, label and id."""
    key = F.concat(F.lit(f"{seed}:{label}:"), row_id.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, digits), 16, 10).cast("bigint")


class Draws:
    """Draws for one row id and seed, each under its own label."""

    def __init__(self, seed: int, row_id: Column):
        self.seed = seed
        self.row_id = row_id

    def raw(self, label: str) -> Column:
        return draw(self.seed, label, self.row_id)

    def integer(self, label: str, low: int, high: int | Column) -> Column:
        """Uniform integer, both ends included.

        The upper end may be a column, such as the row count of a parent table. It is
        then drawn from 60 bits, so parents beyond the first 2**32 get children too.
        """
        if isinstance(high, Column):
            wide = draw(self.seed, label, self.row_id, WIDE_DIGITS)
            return F.lit(low) + wide % (high - F.lit(low) + F.lit(1))
        return F.lit(low) + self.raw(label) % F.lit(high - low + 1)

    def choice(self, label: str, values: list[str]) -> Column:
        options = F.array(*[F.lit(v) for v in values])
        return F.get(options, (self.raw(label) % F.lit(len(values))).cast("int"))

    def weighted(self, label: str, weights: dict[int, int]) -> Column:
        """One of the dict's keys, with a chance in proportion to its weight."""
        spot = self.raw(label) % F.lit(sum(weights.values()))
        keys = list(weights)
        picked = F.lit(keys[-1])
        edge = sum(weights.values())
        for key, following in reversed(list(zip(keys, keys[1:]))):
            edge -= weights[following]
            picked = F.when(spot < edge, F.lit(key)).otherwise(picked)
        return picked

    def chance(self, label: str, probability: float) -> Column:
        return self.raw(label) < F.lit(int(probability * DRAW_RANGE))

    def fixed_point(self, label: str, low: int, high: int, digits: int) -> Column:
        """Uniform decimal on the grid of ``digits`` decimals between two integers."""
        scale = 10**digits
        units = self.integer(label, low * scale, high * scale)
        return (units / F.lit(scale)).cast(f"decimal({digits + 3},{digits})")

    def standard_normal(self, label: str) -> Column:
        """Standard normal number from two uniform draws (Box-Muller)."""
        first = (self.raw(label + "/radius") + F.lit(1)) / F.lit(float(DRAW_RANGE))
        second = self.raw(label + "/angle") / F.lit(float(DRAW_RANGE))
        return F.sqrt(F.lit(-2.0) * F.log(first)) * F.cos(F.lit(2.0 * math.pi) * second)

    def lognormal_integer(self, label: str, mu: float, sigma: float, at_least: int) -> Column:
        """Truncated lognormal number, not below ``at_least``."""
        value = F.exp(F.lit(mu) + F.lit(sigma) * self.standard_normal(label))
        return F.greatest(F.lit(at_least).cast("bigint"), F.floor(value))

    def minute_stamp(self, label: str, start: str, days: int) -> Column:
        """Timestamp at a whole minute, 0 to ``days`` days plus up to 23:59 after ``start``."""
        minutes = (
            self.integer(label + "/day", 0, days) * F.lit(1440)
            + self.integer(label + "/hour", 0, 23) * F.lit(60)
            + self.integer(label + "/minute", 0, 59)
        )
        return F.timestamp_add("MINUTE", minutes, F.lit(start).cast("timestamp_ntz"))

    def days_before(self, label: str, as_of: str, nearest: int, farthest: int) -> Column:
        """Date between ``farthest`` and ``nearest`` days before a reference date."""
        days = self.integer(label, nearest, farthest).cast("int")
        return F.date_sub(F.lit(as_of).cast("date"), days)
