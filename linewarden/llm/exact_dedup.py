"""Exact duplicates by a tree of sorted digest runs.

Each partition sorts the digests of its rows into runs, one per digest range. Runs of one
range then meet in rounds: every round merges ``fan_in`` neighbouring runs (two binomial
steps at once) and keeps, per digest, the smallest identifier and the counts. A digest held
by a third of all rows is one entry per run, so it never makes a task large. Ranges are cut
finer as runs merge: a run is exchanged in few parts of many entries in every round, however
many ranges there are in the end, and a range's last run stays small at any input size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewarden.session import materialize

RUN_SCHEMA = (
    "range int, run long, keys binary, ids binary, nulls binary, counts binary, firsts binary"
)
KEY = "S40"
NO_ID = np.iinfo(np.int64).max


def normal_text(name: str) -> Column:
    """The text with each run of white space as one space; null as empty."""
    text = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def text_digest(name: str) -> Column:
    return F.unhex(F.sha2(normal_text(name).cast("binary"), 256))


def text_digests(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, digest (SHA-256) and n_bytes of every text, runs of white space as one space."""
    return documents.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        text_digest(text_column).alias("digest"),
        F.octet_length(normal_text(text_column)).cast("long").alias("n_bytes"),
    )


def _merged(keys, ids, nulls, counts, firsts):
    """One entry per key: smallest id, rows, and rows that hold this smallest id.

    The stable sort merges runs that are sorted already.
    """
    order = np.argsort(keys, kind="stable")
    keys, ids, nulls, counts, firsts = (a[order] for a in (keys, ids, nulls, counts, firsts))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    if not len(at):
        return keys, ids, nulls, counts, firsts
    smallest = np.minimum.reduceat(ids, at)
    no_id = np.logical_and.reduceat(nulls, at)
    which = np.cumsum(new) - 1
    same = (ids == smallest[which]) & (nulls == no_id[which])
    return (
        keys[at],
        smallest,
        no_id,
        np.add.reduceat(counts, at),
        np.add.reduceat(np.where(same, firsts, 0), at),
    )


def _run_rows(ranges: int, run: int, arrays: tuple) -> pa.RecordBatch:
    keys = arrays[0]
    head = np.frombuffer(keys.tobytes(), ">u4").reshape(len(keys), 10)[:, 0].astype(np.uint64)
    number = ((head * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)
    full, starts = np.unique(number, return_index=True)
    bounds = [*starts.tolist(), len(number)]
    return _batch(
        [
            (r, run, *(a[start:end].tobytes() for a in arrays))
            for r, start, end in zip(full.tolist(), bounds, bounds[1:])
        ]
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 7
    types = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
    names = ["range", "run", "keys", "ids", "nulls", "counts", "firsts"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _arrays(keys: bytes, ids: bytes, nulls: bytes, counts: bytes, firsts: bytes) -> tuple:
    kinds = (KEY, np.int64, bool, np.int64, np.int64)
    return tuple(np.frombuffer(b, k) for b, k in zip((keys, ids, nulls, counts, firsts), kinds))


def _first_runs(ranges: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0)
            nulls = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), bool)
            sizes = batch.column(2).to_numpy(zero_copy_only=False).astype(">u8")
            digests = np.frombuffer(b"".join(batch.column(1).to_pylist()), "S32")
            keys = np.empty((batch.num_rows, 40), np.uint8)
            keys[:, :32] = digests.view(np.uint8).reshape(-1, 32)
            keys[:, 32:] = sizes.view(np.uint8).reshape(-1, 8)
            ones = np.ones(batch.num_rows, np.int64)
            new = _merged(
                keys.reshape(-1).view(KEY),
                ids.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64),
                nulls,
                ones,
                ones,
            )
            held = new if held is None else _merged(*map(np.concatenate, zip(held, new)))
        if held is not None:
            yield _run_rows(ranges, TaskContext.get().partitionId(), held)

    return build


def _merge_runs(ranges: int):
    """Merge the runs of one range and cut the result into the finer ranges below it."""

    def merge(table: pa.Table) -> pa.Table:
        names = ["keys", "ids", "nulls", "counts", "firsts"]
        runs = [_arrays(*row) for row in zip(*(table.column(n).to_pylist() for n in names))]
        merged = _merged(*map(np.concatenate, zip(*runs)))
        return pa.Table.from_batches([_run_rows(ranges, table.column("run")[0].as_py(), merged)])

    return merge


def _ranges(rows: int, rows_per_range: int, fan_in: int) -> int:
    """The least power of ``fan_in`` of ranges that hold ``rows_per_range`` rows each."""
    ranges = 1
    while ranges * rows_per_range < rows:
        ranges *= fan_in
    return ranges


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(2, 7))):
            keys, ids, nulls, counts, firsts = _arrays(*row)
            raw = np.frombuffer(keys.tobytes(), np.uint8).reshape(-1, 40)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k.tobytes() for k in raw[:, :32]], pa.binary()),
                    pa.array(np.ascontiguousarray(raw[:, 32:]).view(">u8").ravel().astype("i8")),
                    pa.array(ids, mask=nulls),
                    pa.array(counts),
                    pa.array(firsts),
                ],
                ["digest", "n_bytes", "keep_id", "group_size", "keep_rows"],
            )


def digest_groups(digests: DataFrame, rows_per_range: int = 250_000, fan_in: int = 4) -> DataFrame:
    """One row per distinct (digest, n_bytes): keep_id, group_size and keep_rows.

    ``digests`` is a stored table with doc_id, digest and n_bytes. Texts of another length
    under the same digest would be told apart, so a merge only ever joins verified equals.
    ``keep_rows`` counts the rows that hold the smallest id.

    A first run has ranges by its own size; each round merges ``fan_in`` runs and makes as many
    ranges of one, until there are enough for all rows.
    """
    sizes = digests.groupBy(F.spark_partition_id().alias("part")).count()
    sizes = sizes.agg(F.sum("count").alias("rows"), F.max("count").alias("most")).first()
    ranges = _ranges((sizes["most"] or 0) * fan_in, rows_per_range, fan_in)
    enough = _ranges(sizes["rows"] or 0, rows_per_range, fan_in)
    runs = materialize(digests.mapInArrow(_first_runs(ranges), RUN_SCHEMA), "digest_runs")
    last = runs.agg(F.max("run").alias("last")).first()["last"] or 0
    while last:
        runs = runs.withColumn("run", F.floor(F.col("run") / fan_in))
        ranges *= fan_in if ranges < enough else 1
        runs = runs.groupBy("range", "run").applyInArrow(_merge_runs(ranges), RUN_SCHEMA)
        last //= fan_in
    return runs.mapInArrow(
        _entries,
        "digest binary, n_bytes long, keep_id long, group_size long, keep_rows long",
    )


def exact_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: doc_id, digest, n_bytes, keep_id, group_size, kept, keep_rows.

    Texts are equal when they are identical after replacing each run of ``[\\x20\\x09-\\x0D]``
    by one space; nothing is trimmed. Null counts as empty, so null and "" are equal. The row
    with the smallest id stays; a row without an id stays only if no equal row has one.
    Rows that repeat both id and text are alike and all marked kept; ``keep_rows`` says how
    many they are. An empty table gives an empty result. Other columns are not read. The join
    back is on a unique right side, so Spark's skew handling splits a digest of many rows.
    """
    digests = materialize(text_digests(documents, id_column, text_column), "digests")
    groups = digest_groups(digests)
    return digests.join(groups, ["digest", "n_bytes"], "left").select(
        "doc_id",
        "digest",
        "n_bytes",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "keep_rows",
    )


def drop_exact_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents with exactly one row of each group of equal texts, columns unchanged."""
    report = materialize(
        exact_duplicates(documents, id_column, text_column).filter(
            ~F.col("kept") | (F.col("keep_rows") > 1)
        ),
        "exact_report",
    )
    prefix = "_exact_dedup_"
    marks = report.select(*[F.col(c).alias(prefix + c) for c in ("doc_id", "digest", "kept")])
    keyed = documents.select(
        "*",
        F.col(f"`{id_column}`").cast("long").alias(prefix + "own_id"),
        text_digest(text_column).alias(prefix + "own_digest"),
    )
    same = F.col(prefix + "doc_id").eqNullSafe(F.col(prefix + "own_id")) & (
        F.col(prefix + "digest") == F.col(prefix + "own_digest")
    )
    # The marks grow with the data, so they are never sent to all tasks, however few they are.
    rest = keyed.join(marks.hint("merge"), same, "left_anti")
    again = marks.filter(F.col(prefix + "kept"))
    if not again.isEmpty():
        once = keyed.join(again.hint("merge"), same, "left_semi")
        rest = rest.unionByName(once.dropDuplicates([prefix + "own_id", prefix + "own_digest"]))
    return rest.select(*[F.col(f"`{c}`") for c in documents.columns])
