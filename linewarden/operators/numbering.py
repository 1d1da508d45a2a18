"""Dense numbers for rows with any keys, without a one-task window."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewarden.session import materialize

# Spark's increasing ids hold the partition above this many bits of row number.
ROW_BITS = 33
_PLACE, _PART, _BEFORE = "__place", "__part", "__before"


class Numbered(NamedTuple):
    """Rows with their numbers, and how many there are."""

    rows: DataFrame
    count: int


def number_rows(
    rows: DataFrame, order: list[str | Column], name: str = "number", first: int = 1
) -> Numbered:
    """The rows with ``name``, their place in ``order`` counted from ``first`` without gaps.

    Two passes: the rows are sorted over range partitions and written down with their place in
    their partition; then the partitions' sizes, one number each, are summed up and added. Rows
    equal in ``order`` are numbered in any order, and one task sorts them, so ``order`` should
    be a key. An empty table has no numbers. A column called ``name`` is replaced.
    """
    kept = [c for c in rows.columns if c != name]
    placed = materialize(
        rows.orderBy(*order).select(
            *[f"`{c}`" for c in kept], F.monotonically_increasing_id().alias(_PLACE)
        ),
        "numbered",
    )
    part = F.shiftright(_PLACE, ROW_BITS)
    # One row per partition of the sort.
    sizes = {r["part"]: r["count"] for r in placed.groupBy(part.alias("part")).count().collect()}
    before, total = [], 0
    for number in sorted(sizes):
        before.append((number, first + total))
        total += sizes[number]
    offsets = rows.sparkSession.createDataFrame(before, f"{_PART} long, {_BEFORE} long")
    numbered = placed.withColumn(_PART, part).join(F.broadcast(offsets), _PART)
    row = F.col(_PLACE).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return Numbered(
        numbered.select(*[f"`{c}`" for c in kept], (F.col(_BEFORE) + row).alias(name)), total
    )
