"""Databases, tables and views of the model in Spark's catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewarden import model


def create_database(
    spark: SparkSession, name: str, location: str | None = None, replace: bool = False
) -> None:
    """Create a database; ``replace`` drops the old one with its tables.

    The current database stays what it was.
    """
    if replace:
        drop_database(spark, name)
    at = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(name)}{at}")


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {_name(name)} CASCADE")


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_tables(spark: SparkSession, database: str) -> None:
    """Create every missing table of the model, with its lengths and defaults."""
    for table in model.TABLES.values():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_name(database)}.{_name(table.name)} ({table.ddl}) "
            "USING parquet"
        )


def with_defaults(df: DataFrame, table: model.Table, keep: tuple[str, ...] = ()) -> DataFrame:
    """The table's columns in order: absent ones get their default, or null without one.

    A null that is present stays null, as in an insert that names the column. ``keep``
    names further columns to carry along.
    """
    columns = []
    for column in table.columns:
        if column.name in df.columns:
            value = F.col(column.name)
        elif column.default:
            value = F.expr(column.default)
        else:
            value = F.lit(None)
        columns.append(value.cast(column.type).alias(column.name))
    return df.select(*columns, *keep)


def register_views(views: dict[str, DataFrame]) -> None:
    """Make named DataFrames available to SQL as temporary views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
