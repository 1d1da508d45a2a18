"""Equi-joins that hold when one key carries a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewarden import model


def left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer join in which both sides may have a hot key.

    Spark can split a skewed partition on either side of an inner join, but not on
    the right of a left outer one. So matched rows come from an inner join, and the
    rest from an anti join against the distinct right-hand keys, which are combined
    before they are shuffled. Both read the same shuffle of the left side.
    """
    matched = left.join(right, key, "inner")
    unmatched = left.join(right.select(key).distinct(), key, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def join_lookup(df: DataFrame, name: str, on: str, columns: dict[str, str]) -> DataFrame:
    """Inner join to a lookup table, taking ``columns`` (lookup name to output name).

    A lookup is a literal of at most 13 rows, so broadcasting it is always safe.
    """
    key = model.TABLES[name].primary_key
    rows = model.lookup(df.sparkSession, name)
    side = rows.select(
        F.col(key).alias(on), *[F.col(c).alias(out) for c, out in columns.items()]
    )
    return df.join(F.broadcast(side), on, "inner")
