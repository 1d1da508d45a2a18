"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 6)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(_cell(row[i]) for i in order)) for row in rows)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(connection, sql):
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    return names, _rows(names, result.fetchall())


def assert_same(df, connection, sql):
    names, expected = duck_rows(connection, sql)
    assert sorted(df.columns) == sorted(names)
    actual = spark_rows(df)
    assert len(actual) == len(expected)
    differing = [(a, e) for a, e in zip(actual, expected) if a != e]
    assert not differing, differing[:3]
