"""The stored keys of a table beside it, in parts by key range.

An append has to know which of its keys are stored. With an index it reads the parts its keys
fall into, not the whole table: a batch of new, rising ids meets the last part only. Each part
is a partition folder, so Spark prunes the others before it lists their files. A lookup of
surrogate keys reads the parts in the same way, from an index that carries them.

The index notes how many rows the table had. If the table has another number when the index is
opened, because an append failed half-way or went past the index, it is built anew, as it is when
one part has grown far beyond the others.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.session import remove_folder

Key = tuple[str, ...]

# Parts are found by a decision tree in the query, so there is a limit to their number.
MOST_PARTS = 512
# A part may have this many times the mean number of rows.
UNEVEN = 8


class KeyIndex(NamedTuple):
    """An opened index: where it lies, its key, what else it carries, first keys of the parts."""

    spark: SparkSession
    root: str
    key: Key
    carried: Key
    firsts: list[tuple]


def _folder(root: str, key: Key) -> str:
    return f"{root}/{'_'.join(key)}"


def _whole(rows: DataFrame, key: Key) -> DataFrame:
    for column in key:
        rows = rows.filter(F.col(column).isNotNull())
    return rows


def build_index(
    table: DataFrame, root: str, key: Key, carried: Key = (), parts: int = 64
) -> KeyIndex:
    """Write the complete keys of a table in parts of about equal size; an old index goes."""
    if not 1 <= parts <= MOST_PARTS:
        raise ValueError(f"an index has 1 to {MOST_PARTS} parts")
    spark, folder = table.sparkSession, _folder(root, key)
    remove_folder(spark, folder)
    rows = _whole(table, key).select(*key, *carried)
    ranged = rows.repartitionByRange(parts, *key).withColumn("part", F.spark_partition_id())
    ranged.write.partitionBy("part").parquet(f"{folder}/keys")
    _note(spark, folder, table.count())
    return _opened(spark, root, table, key, carried)


def _note(spark: SparkSession, folder: str, rows: int) -> None:
    noted = spark.range(1).select(F.lit(rows).cast("long").alias("rows"))
    noted.coalesce(1).write.mode("overwrite").parquet(f"{folder}/noted")


def _keys(spark: SparkSession, table: DataFrame, root: str, key: Key, carried: Key) -> DataFrame:
    schema = table.select(*key, *carried).schema.add("part", T.IntegerType())
    return spark.read.schema(schema).parquet(f"{_folder(root, key)}/keys")


def _opened(
    spark: SparkSession, root: str, table: DataFrame, key: Key, carried: Key
) -> KeyIndex:
    keys = _keys(spark, table, root, key, carried)
    first = F.min(F.struct(*key)).alias("first")
    # One row per part, of at most MOST_PARTS.
    rows = keys.groupBy("part").agg(first).orderBy("part").collect()
    return KeyIndex(spark, root, key, carried, [(r["part"], tuple(r["first"])) for r in rows])


def open_index(
    table: DataFrame, root: str, key: Key, carried: Key = (), parts: int = 64
) -> KeyIndex:
    """The index of a table's key, built if there is none that fits the table."""
    spark, folder = table.sparkSession, _folder(root, key)
    try:
        noted = spark.read.schema("rows long").parquet(f"{folder}/noted").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        noted = None
    if noted is None or noted["rows"] != table.count():
        return build_index(table, root, key, carried, parts)
    sizes = _keys(spark, table, root, key, carried).groupBy("part").count().collect()
    rows = sum(r["count"] for r in sizes)
    if sizes and max(r["count"] for r in sizes) > UNEVEN * max(1000, rows / parts):
        return build_index(table, root, key, carried, parts)
    return _opened(spark, root, table, key, carried)


def part_of(index: KeyIndex, rows: DataFrame) -> Column:
    """The part a key belongs to: the last one whose first key is not above it."""
    key = F.struct(*[F.col(c).cast(rows.schema[c].dataType) for c in index.key])

    def first(at: int) -> Column:
        values = zip(index.key, index.firsts[at][1])
        return F.struct(*[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in values])

    def search(low: int, high: int) -> Column:
        if high - low <= 1:
            return F.lit(index.firsts[low][0])
        middle = (low + high) // 2
        return F.when(key < first(middle), search(low, middle)).otherwise(search(middle, high))

    return search(0, len(index.firsts)) if index.firsts else F.lit(0)


def met_keys(index: KeyIndex, table: DataFrame, rows: DataFrame) -> DataFrame:
    """The stored keys, and what is carried, of the parts that keys of ``rows`` fall into."""
    wanted = _whole(rows.select(*index.key), index.key)
    # At most as many numbers as there are parts.
    met = [r["part"] for r in wanted.select(part_of(index, rows).alias("part")).distinct().collect()]
    keys = _keys(index.spark, table, index.root, index.key, index.carried)
    return keys.filter(F.col("part").isin(sorted(met))).drop("part")


def extend_index(index: KeyIndex, added: DataFrame, table: DataFrame) -> None:
    """Add the keys of rows that were appended to the table, then note its rows."""
    rows = _whole(added, index.key)
    keyed = rows.select(*index.key, *index.carried, part_of(index, rows).alias("part"))
    folder = _folder(index.root, index.key)
    keyed.write.mode("append").partitionBy("part").parquet(f"{folder}/keys")
    _note(index.spark, folder, table.count())


def key_of_indexed(rows: DataFrame, stored: DataFrame, index: KeyIndex) -> DataFrame:
    """Rows with the carried columns of their key, read from the parts they meet only.

    No row is lost: one whose key is not stored has nulls.
    """
    return rows.join(met_keys(index, stored, rows), list(index.key), "left")
