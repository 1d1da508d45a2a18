"""Shards of nearly equal bytes by sampled splitters.

Keys are drawn with a chance in proportion to their size, the sample's quantiles cut the key
order into many narrow ranges, and an exact count of each range's bytes follows. Ranges that
turn out overfull are cut again at splitters of their own, which fall between rows of one key
only if the key alone is too large to stay whole. Shards are runs of consecutive ranges, so a running sum over the ranges' totals and one
within each range place every row; no step sorts or sums all rows in one task.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linewarden.session import materialize

PREFIX = "_shard_"
KEY, TIE, SIZE, RANGE = (PREFIX + n for n in ("key", "tie", "size", "range"))


def _range_number(splitters: list[tuple[int, int]]) -> Column:
    """The number of splitters at or below (key, tie)."""

    keys, ties = (np.array([s[i] for s in splitters], np.int64) for i in (0, 1))

    @F.pandas_udf("int")
    def number(key: pd.Series, tie: pd.Series) -> pd.Series:
        values, within = key.to_numpy(np.int64), tie.to_numpy(np.int64)
        found = np.searchsorted(keys, values, "left")
        after = np.searchsorted(keys, values, "right")
        # Only keys that a splitter names depend on the row; there are few of them.
        for low in np.unique(found[after > found]):
            at = np.flatnonzero((found == low) & (after > low))
            cuts = ties[low : after[at[0]]]
            found[at] = low + np.searchsorted(cuts, within[at], "right")
        return pd.Series(found.astype(np.int32))

    return number(F.col(KEY), F.col(TIE))


def _sample(rows: DataFrame, wanted: int, total: int) -> list[tuple[int, int, float]]:
    """About ``wanted`` keys, each drawn with a chance in proportion to its size.

    Returns (key, tie, weight) in key order, where the weights estimate bytes. The draw is
    a hash of the row's key, so a task that runs again draws the same rows.
    """
    chance = F.col(SIZE) * (wanted / max(total, 1))
    draw = F.pmod(F.xxhash64(KEY, TIE, F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.filter(draw < chance).select(
        KEY, TIE, F.greatest(F.col(SIZE).cast("double"), F.lit(total / wanted)).alias("weight")
    )
    return sorted(tuple(r) for r in drawn.collect())


def _quantiles(
    sample: list[tuple[int, int, float]], ranges: int, heavy: frozenset[int] = frozenset()
) -> list[tuple]:
    """Splitters that cut the sample's weight into ``ranges`` equal parts.

    A splitter stands before all rows of its key, unless the key is ``heavy``: only those are cut.
    """
    total = sum(w for _, _, w in sample)
    splitters, seen = [], 0.0
    for key, tie, weight in sample:
        if seen + weight > (len(splitters) + 1) * total / ranges:
            splitters.append((key, tie if key in heavy else -1))
            while seen + weight > (len(splitters) + 1) * total / ranges and splitters:
                splitters.append(splitters[-1])
        seen += weight
    return sorted(set(splitters))


def _range_totals(rows: DataFrame, splitters: list[tuple]) -> list[tuple[int, int]]:
    """(range, bytes) of every range that has rows: at most one more than the splitters."""
    totals = rows.groupBy(_range_number(splitters).alias(RANGE)).agg(F.sum(SIZE).alias("bytes"))
    return [(r[RANGE], r["bytes"]) for r in totals.collect()]


def splitters_of(
    rows: DataFrame,
    total: int,
    limit: float,
    ranges: int = 512,
    per_range: int = 40,
    rounds: int = 3,
) -> list[tuple]:
    """Splitters (key, tie) such that no range holds much over total / ranges bytes.

    Each round subdivides the ranges that hold over twice their share, between keys or, where
    a key holds over ``limit`` bytes, between its rows. The driver sees the sample
    (``ranges * per_range`` keys on average, however large the table), one sum per range and
    the keys over the limit, of which there are at most total / limit.
    """
    wanted = ranges * per_range
    splitters = _quantiles(_sample(rows, wanted, total), ranges)
    share = total / ranges
    for _ in range(rounds):
        overfull = {r: b for r, b in _range_totals(rows, splitters) if b > 2 * share}
        if not overfull:
            break
        number = _range_number(splitters)
        inside = rows.withColumn(RANGE, number).filter(F.col(RANGE).isin(list(overfull)))
        held = sum(overfull.values())
        sums = inside.groupBy(KEY).agg(F.sum(SIZE).alias("bytes"))
        heavy = frozenset(r[KEY] for r in sums.filter(F.col("bytes") > limit).collect())
        by_range: dict[int, list] = {r: [] for r in overfull}
        for item in _sample(inside, wanted, held):
            by_range[bisect_right(splitters, item[:2])].append(item)
        more = [
            cut
            for r, sample in by_range.items()
            for cut in _quantiles(sample, int(2 * overfull[r] / share) + 1, heavy)
        ]
        if not set(more) - set(splitters):
            break
        splitters = sorted({*splitters, *more})
    return splitters


def shard_by_bytes(
    records: DataFrame,
    key: Column,
    size: Column,
    shards: int = 16,
    ranges: int = 512,
    whole_key_share: float = 1 / 16,
) -> DataFrame:
    """The records with ``shard`` (0 .. shards-1) and ``slot`` (gapless from 0 in each shard).

    ``key`` is a long that orders the records, ``size`` their bytes. The shards are ranges of
    the key order with nearly equal bytes. It is part of the law that rows of one key stay
    together if they hold at most ``whole_key_share`` of a shard's share, at every size of the
    table; a larger key is cut between its rows, as are
    fully repeated rows, which a row number tells apart. Null keys come first, as one key;
    null sizes count 0. Every record is in exactly one shard. A table of fewer rows than
    shards leaves shards empty; an empty table gives an empty result. Columns named shard or
    slot are replaced.
    """
    columns = [c for c in records.columns if c not in ("shard", "slot")]
    rows = materialize(
        records.select(
            *[F.col(f"`{c}`") for c in columns],
            F.coalesce(key.cast("long"), F.lit(-(1 << 63))).alias(KEY),
            F.monotonically_increasing_id().alias(TIE),
            F.coalesce(size.cast("long"), F.lit(0)).alias(SIZE),
        ),
        "shard_rows",
    )
    narrow = rows.select(KEY, TIE, SIZE)
    total = narrow.agg(F.sum(SIZE).alias("total")).first()["total"] or 0
    limit = total / shards * whole_key_share
    splitters = splitters_of(narrow, total, limit, ranges) if total else []

    numbered = materialize(rows.withColumn(RANGE, _range_number(splitters)), "shard_ranges")
    sums = numbered.groupBy(RANGE).agg(F.sum(SIZE).alias("bytes"))
    before, start = [], 0
    for r in sorted(tuple(r) for r in sums.collect()):
        before.append((r[0], start))
        start += r[1]
    # One row per range: at most the splitters' number and one.
    offsets = records.sparkSession.createDataFrame(before, f"{RANGE} int, {PREFIX}before long")

    in_range = Window.partitionBy(RANGE).orderBy(KEY, TIE)
    so_far = in_range.rowsBetween(Window.unboundedPreceding, -1)
    of_key = Window.partitionBy(RANGE, KEY)
    placed = numbered.withColumn(
        PREFIX + "inside", F.coalesce(F.sum(SIZE).over(so_far), F.lit(0))
    )
    placed = placed.withColumns(
        {
            PREFIX + "key_bytes": F.sum(SIZE).over(of_key),
            PREFIX + "key_start": F.min(PREFIX + "inside").over(of_key),
        }
    ).join(F.broadcast(offsets), RANGE, "left")
    share = max(total, 1) / shards
    whole = F.col(PREFIX + "key_bytes") <= share * whole_key_share
    middle = F.col(PREFIX + "before") + F.when(
        whole, F.col(PREFIX + "key_start") + F.col(PREFIX + "key_bytes") / 2
    ).otherwise(F.col(PREFIX + "inside") + F.col(SIZE) / 2)
    placed = placed.withColumn(
        "shard", F.least(F.floor(middle / share), F.lit(shards - 1)).cast("int")
    )
    placed = materialize(placed.select(*columns, RANGE, KEY, TIE, "shard"), "shard_placed")

    # Rows of a range and shard are numbered from the rows of the earlier ranges of the shard.
    pieces = placed.groupBy("shard", RANGE).count().collect()
    slots, counts = [], dict.fromkeys(range(shards), 0)
    for shard, number, n in sorted(tuple(r) for r in pieces):
        slots.append((shard, number, counts[shard]))
        counts[shard] += n
    first = records.sparkSession.createDataFrame(
        slots, f"shard int, {RANGE} int, {PREFIX}first long"
    )
    numbering = Window.partitionBy("shard", RANGE).orderBy(KEY, TIE)
    return (
        placed.withColumn(PREFIX + "row", F.row_number().over(numbering))
        .join(F.broadcast(first), ["shard", RANGE], "left")
        .select(
            *[F.col(f"`{c}`") for c in columns],
            "shard",
            (F.col(PREFIX + "first") + F.col(PREFIX + "row") - 1).cast("long").alias("slot"),
        )
    )
