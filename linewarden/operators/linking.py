"""Draws and links over tables whose keys are any values, with gaps or not numbers at all.

The parents' keys get dense numbers in two passes (``numbering``). A draw or a round robin
gives a number, and a join on it the key. The join is on evenly spread numbers, so there is no
hot key unless there are few parents; those Spark broadcasts by their measured size.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewarden.functions.draws import Draws
from linewarden.functions.text import padded_code
from linewarden.operators.numbering import number_rows

_PLACE = "__parent_place"


class Keys(NamedTuple):
    """The distinct keys of a table, numbered in their order from 1, and how many there are."""

    rows: DataFrame
    count: int


def keys_of(table: DataFrame, key: str) -> Keys:
    """The numbered keys of a table; null is no key, a repeated key counts once."""
    distinct = table.select(F.col(key).alias("key")).filter(F.col("key").isNotNull()).distinct()
    rows, count = number_rows(distinct, ["key"], "place")
    return Keys(rows, count)


def are_dense(table: DataFrame, key: str) -> bool:
    """True if the keys are exactly the numbers from 1 to their count."""
    row = table.agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count_distinct(key).alias("n")
    ).first()
    return row["n"] == 0 or (row["low"] == 1 and row["high"] == row["n"])


def key_at(rows: DataFrame, place: Column, keys: Keys, name: str) -> DataFrame:
    """The rows with ``name``, the key at a place counted from 1; null at other places.

    A column called ``name`` is replaced, also when ``place`` is made of it.
    """
    kept = [c for c in rows.columns if c != name]
    placed = rows.select(*[f"`{c}`" for c in kept], place.cast("long").alias(_PLACE))
    side = keys.rows.select(F.col("place").alias(_PLACE), F.col("key").alias(name))
    joined = placed.join(side, _PLACE, "left")
    order = [c if c in kept else name for c in rows.columns]
    return joined.select(*[f"`{c}`" for c in dict.fromkeys([*order, name])])


def draw_key(
    rows: DataFrame, row_id: str, keys: Keys, name: str, label: str, seed: int = 7
) -> DataFrame:
    """The rows with ``name``, one of the keys drawn uniformly; null if there are none."""
    if not keys.count:
        return key_at(rows, F.lit(None), keys, name)
    spot = Draws(seed, F.col(row_id)).integer(label, 1, F.lit(keys.count).cast("long"))
    return key_at(rows, spot, keys, name)


def round_robin(children: DataFrame, child: str, keys: Keys, name: str) -> DataFrame:
    """One row per distinct child key, in their order dealt over the keys in theirs.

    Columns: ``link_id`` (from 1), the child key and ``name``, the key it is linked to.
    """
    numbered = keys_of(children, child).rows.select(
        F.col("place").alias("link_id"), F.col("key").alias(child)
    )
    if not keys.count:
        return key_at(numbered, F.lit(None), keys, name)
    return key_at(numbered, F.lit(1) + (F.col("link_id") - 1) % keys.count, keys, name)


def numbered_codes(
    rows: DataFrame, order: list[str | Column], prefix: str, name: str, width: int = 4
) -> DataFrame:
    """The rows with ``name``, a code of the prefix and the padded place in ``order``."""
    numbered = number_rows(rows, order, _PLACE).rows
    return numbered.withColumn(name, padded_code(prefix, F.col(_PLACE), width)).drop(_PLACE)
