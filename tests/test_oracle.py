"""Every registered query against its independent DuckDB statement."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import assert_same, duck


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, sf_dir, connection, name):
    result = queries()[name](spark, sf_dir)
    sql = oracle_sql().get(name)
    if sql is None:
        assert result.count() > 0
    else:
        assert_same(result, connection, sql)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_known_answer(spark):
    rows = {tuple(r) for r in entry(spark).collect()}
    assert rows == {
        ("Bell", 189, 35, 18.5),
        ("Rogers", 201, 47, 23.4),
        ("SaskTel", 131, 33, 25.2),
        ("Shaw", 137, 27, 19.7),
        ("Telus", 235, 45, 19.1),
        ("Videotron", 148, 35, 23.6),
    }
