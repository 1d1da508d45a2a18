"""Packing as a cutting-stock problem: column generation over a histogram of lengths.

Documents are cut into pieces of at most one sequence. The pieces' lengths are counted, in
classes a few tokens wide and of one length where many pieces would lose places; a linear program over patterns (how many pieces of each class share
a sequence) is solved on the counts, where a knapsack over the classes prices the columns.
Whole parts of the solution are used as they are, the rest is packed best fit decreasing.
Every piece then finds its place by its rank within its class. Only the counts, whose number
does not depend on the data, are seen by the driver.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linewarden.llm.encoding import encoder_of, vocabulary_of
from linewarden.llm.words import rows_of, utf8
from linewarden.session import materialize

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


# --- the program --------------------------------------------------------------------------


def knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The best value of a pattern and how many of each class it takes.

    Classes are tried one after the other, each in any number and in all rooms at once. One
    that is worth no more than a smaller one is never needed.
    """
    by = np.lexsort((-values, sizes))
    so_far = np.maximum.accumulate(np.append(0.0, values[by]))
    needed = by[values[by] > so_far[:-1]]
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for at in needed:
        size, value = int(sizes[at]), float(values[at])
        times = -(-(capacity + 1) // size)
        rooms = np.full(times * size, -np.inf)
        rooms[: capacity + 1] = best
        gain = (np.arange(times) * value)[:, None]
        filled = np.maximum.accumulate(rooms.reshape(times, size) - gain, axis=0) + gain
        filled = filled.ravel()[: capacity + 1]
        better = filled > best + 1e-12
        best[better], choice[better] = filled[better], at
    pattern = np.zeros(len(sizes))
    room = capacity
    while choice[room] >= 0:
        pattern[choice[room]] += 1
        room -= int(sizes[choice[room]])
    return float((pattern * values).sum()), pattern


def inverted(matrix: np.ndarray) -> np.ndarray:
    """The inverse by Gauss-Jordan elimination with row pivots.

    Plain element-wise steps on purpose: threaded linear algebra in the driver's process,
    beside the JVM it started, was seen to hang.
    """
    m = len(matrix)
    rows = np.hstack([matrix, np.eye(m)])
    for at in range(m):
        pivot = at + int(np.abs(rows[at:, at]).argmax())
        rows[[at, pivot]] = rows[[pivot, at]]
        rows[at] /= rows[at, at]
        factors = rows[:, at].copy()
        factors[at] = 0.0
        rows -= factors[:, None] * rows[at]
    return rows[:, m:]


def column_generation(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 0.001, rounds: int = 4000
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and their amounts that cover the demand with few sequences.

    Revised simplex from the patterns of one class each. Ends when the sequences used are
    within ``gap`` of the dual bound, or after ``rounds`` pivots with what is reached then.
    """
    m = len(sizes)
    per = np.maximum(capacity // sizes, 1).astype(float)
    basis, inverse = np.diag(per), np.diag(1 / per)
    amounts = demand / per
    bound = 0.0
    for pivot in range(rounds):
        duals = inverse.sum(axis=0)
        value, pattern = knapsack(sizes, np.maximum(duals, 0), capacity)
        # Duals divided by the best value are feasible, which bounds the optimum from below.
        bound = max(bound, float((np.maximum(duals, 0) * demand).sum()) / max(value, 1.0))
        if value <= 1 + 1e-9 or amounts.sum() <= bound * (1 + gap):
            break
        direction = (inverse * pattern).sum(axis=1)
        rising = direction > 1e-9
        if not rising.any():
            break
        ratio = np.full(m, np.inf)
        ratio[rising] = amounts[rising] / direction[rising]
        out = int(ratio.argmin())
        step = max(ratio[out], 0.0)
        amounts -= step * direction
        amounts[out] = step
        basis[:, out] = pattern
        row = inverse[out] / direction[out]
        inverse -= direction[:, None] * row
        inverse[out] = row
        if pivot % 200 == 199:
            inverse = inverted(basis)
            amounts = np.maximum((inverse * demand).sum(axis=1), 0)
    return basis, np.maximum(amounts, 0)


def best_fit(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns of single sequences for a few left-over pieces, largest first."""
    patterns: list[np.ndarray] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    for at in np.argsort(-sizes, kind="stable"):
        for _ in range(int(counts[at])):
            room = next((r for r in range(sizes[at], capacity + 1) if by_room[r]), None)
            if room is None:
                patterns.append(np.zeros(len(sizes), np.int64))
                number, room = len(patterns) - 1, capacity
            else:
                number = by_room[room].pop()
            patterns[number][at] += 1
            by_room[room - sizes[at]].append(number)
    return patterns


def class_tops(counts: dict[int, int], unit: int, exact: int, loss: float = 0.0002) -> np.ndarray:
    """The largest length of each class, rising: the multiples of ``unit``, and the ``exact``
    lengths that would lose the most places if they were rounded up to those, where that is a
    share of at least ``loss`` of all places.

    ``counts`` gives the pieces of each length; classes without a piece are left out.
    """
    lengths = np.array(sorted(counts), np.int64)
    pieces = np.array([counts[n] for n in lengths], np.int64)
    rounded = -(-lengths // unit) * unit
    lost = (rounded - lengths) * pieces
    most = np.lexsort((lengths, -lost))[:exact]
    own = np.zeros(len(lengths), bool)
    own[most] = lost[most] > loss * (rounded * pieces).sum()
    return np.unique(np.where(own, lengths, rounded))


def layout(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Where the pieces of each class go: (class, first rank, first sequence, per sequence).

    ``counts`` gives the pieces of each class, which is named by its largest length. From ``first rank`` on, pieces go ``per sequence`` at a time
    to ``first sequence`` and the following ones, up to the next entry of the class. Every
    class is covered for all its pieces.
    """
    tops = np.array(sorted(counts), np.int64)
    if not len(tops):
        return []
    demand = np.array([counts[s] for s in tops], np.int64)
    # In the largest steps that all lengths and the capacity are multiples of.
    step = int(np.gcd.reduce(np.append(tops, capacity)))
    sizes, capacity = tops // step, capacity // step
    basis, amounts = column_generation(sizes, demand.astype(float), capacity)
    left = demand.copy()
    used: list[tuple[np.ndarray, int]] = []
    for column, amount in zip(basis.T, amounts):
        pattern, times = column.astype(np.int64), int(math.floor(amount + 1e-9))
        if times > 0:
            used.append((pattern, times))
            left -= pattern * times
    used += [(p, 1) for p in best_fit(sizes, np.maximum(left, 0), capacity)]
    entries, rank, sequence = [], np.zeros(len(sizes), np.int64), 0
    for pattern, times in used:
        taken = False
        for at in np.flatnonzero(pattern):
            if rank[at] < demand[at]:
                entries.append((int(tops[at]), int(rank[at]), sequence, int(pattern[at])))
                rank[at] += pattern[at] * times
                taken = True
        sequence += times if taken else 0
    return entries


# --- pieces and places --------------------------------------------------------------------


def _pieces(vocabulary, capacity: int, end_id: int):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in rows_of(iter([batch]), "doc_id", "text"):
                ids = memoryview(encoder.encode(text) + end)
                for at in range(0, len(ids), 4 * capacity):
                    piece = ids[at : at + 4 * capacity]
                    values = (doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4)
                    for column, value in zip(rows, values):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names)

    return run


def _place(entries: list[tuple[int, int, int, int]]):
    """The sequence of each piece from its class and rank."""
    entries = sorted(entries)
    keys = np.array([(size << 48) + rank for size, rank, _, _ in entries], np.int64)
    ranks, sequences, per = (np.array([e[i] for e in entries], np.int64) for i in (1, 2, 3))

    @F.pandas_udf("long")
    def sequence(size: pd.Series, rank: pd.Series) -> pd.Series:
        at = np.searchsorted(keys, (size.to_numpy() << 48) + rank.to_numpy(), side="right") - 1
        return pd.Series(sequences[at] + (rank.to_numpy() - ranks[at]) // per[at])

    return sequence


def pack_documents(
    documents: DataFrame,
    vocabulary_path: str,
    capacity: int = 4096,
    end_id: int = 2,
    unit: int = 16,
    exact: int = 64,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows_per_group: int = 200_000,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its whole text and ``end_id``; it is cut into pieces of
    ``capacity`` ids and one rest, so every id is in exactly one piece. ``ids_crc32`` is of the
    piece's ids as little-endian unsigned 32-bit numbers. Pieces fill the sequences from
    offset 0 without gaps. Null and empty texts are one end id. Repeated rows are packed as
    often as they occur; a null id stays null. An empty table gives an empty result. Other
    columns are not read. For the program, lengths are rounded up to ``unit``, but for up to
    ``exact`` ones that would lose many places. A class that many pieces share is ranked in
    groups of a bounded size, whose totals are summed first.
    """
    if capacity % unit:
        raise ValueError("the capacity must be a multiple of the unit")
    vocabulary = vocabulary_of(documents.sparkSession, vocabulary_path)
    rows = documents.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), utf8(text_column).alias("text")
    )
    cut = rows.mapInArrow(_pieces(vocabulary, capacity, end_id), PIECES)
    pieces = materialize(
        cut.withColumn("piece", F.monotonically_increasing_id()), "pieces"
    )
    # At most ``capacity`` lengths.
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    tops = class_tops(counts, unit, exact)
    number = {length: int(np.searchsorted(tops, length)) for length in counts}
    classes = dict.fromkeys(tops.tolist(), 0)
    for length, n in counts.items():
        classes[int(tops[number[length]])] += n
    entries = [
        (int(np.searchsorted(tops, top)), *place) for top, *place in layout(classes, capacity)
    ]
    if not entries:
        return pieces.select(
            *PIECES.replace(" long", "").split(", "),
            F.lit(0).cast("long").alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        )

    groups = 1 + sum(counts.values()) // rows_per_group
    sizes = documents.sparkSession.createDataFrame(sorted(number.items()), "length long, size long")
    # One row per length.
    sized = pieces.join(F.broadcast(sizes), "length")
    grouped = sized.withColumn("group", F.pmod(F.xxhash64("piece"), F.lit(groups)))
    before = Window.partitionBy("size").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        grouped.groupBy("size", "group")
        .count()
        .select(
            "size", "group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")
        )
    )
    in_group = Window.partitionBy("size", "group").orderBy("piece")
    ranked = (
        grouped.withColumn("row", F.row_number().over(in_group))
        .join(starts, ["size", "group"])
        .withColumn("rank", F.col("first") + F.col("row") - 1)
    )
    placed = ranked.withColumn("sequence_id", _place(entries)(F.col("size"), F.col("rank")))
    so_far = (
        Window.partitionBy("sequence_id")
        .orderBy(F.col("size").desc(), "piece")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        F.coalesce(F.sum("length").over(so_far), F.lit(0)).alias("offset"),
    )
