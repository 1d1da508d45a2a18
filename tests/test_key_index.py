from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from linewarden import model
from linewarden.operators import generate
from linewarden.sources import catalog, inserts, key_index
from tests.test_inserts import frame, one_by_one, random_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def table(spark):
    rows = [(i * 3, f"c{i:05d}", None if i % 9 == 0 else i) for i in range(2000)]
    return spark.createDataFrame(rows, "id long, code string, other int")


def test_only_the_parts_met_are_read(spark, table, tmp_path):
    index = key_index.open_index(table, str(tmp_path), ("id",), ("code",), parts=16)
    assert len(index.firsts) == 16
    new = spark.createDataFrame([(i,) for i in range(5950, 6100)], "id long")
    met = key_index.met_keys(index, table, new)
    assert "PartitionFilters: [isnotnull(part" in plan(met) and "= 15)]" in plan(met)
    held = met.count()
    assert 0 < held < 300
    assert met.filter("id >= 5950").count() == table.filter("id >= 5950").count()
    low = spark.createDataFrame([(-5,), (None,)], "id long")
    assert {r["id"] for r in key_index.met_keys(index, table, low).collect()} >= {0, 3}
    none = spark.createDataFrame([(None,)], "id long")
    assert key_index.met_keys(index, table, none).count() == 0


def test_lookup_by_text_and_by_two_columns(spark, table, tmp_path):
    index = key_index.open_index(table, str(tmp_path), ("code",), ("id",), parts=7)
    asked = spark.createDataFrame([("c00007",), ("nope",), (None,)], "code string")
    rows = {r["code"]: r["id"] for r in key_index.key_of_indexed(asked, table, index).collect()}
    assert rows == {"c00007": 21, "nope": None, None: None}
    pair = key_index.open_index(table, str(tmp_path), ("other", "code"), (), parts=7)
    asked = table.filter("id % 5 = 0").select("other", "code")
    held = key_index.met_keys(pair, table, asked)
    whole = asked.filter("other IS NOT NULL")
    assert whole.join(held, ["other", "code"]).count() == whole.count()


def test_an_index_that_does_not_fit_is_built_anew(spark, table, tmp_path):
    root = str(tmp_path)
    key_index.open_index(table, root, ("id",), parts=4)
    more = table.unionByName(table.withColumn("id", F.col("id") + 1))
    index = key_index.open_index(more, root, ("id",), parts=4)
    assert key_index.met_keys(index, more, more).count() == 4000


def test_an_uneven_index_is_built_anew(spark, tmp_path):
    first = spark.range(100)
    index = key_index.open_index(first, str(tmp_path), ("id",), parts=16)
    added = spark.range(100, 20_000)
    whole = spark.range(20_000)
    key_index.extend_index(index, added, whole)
    index = key_index.open_index(whole, str(tmp_path), ("id",), parts=16)
    assert index.firsts[1][1][0] > 500
    assert key_index.met_keys(index, whole, whole).count() == 20_000


@pytest.mark.parametrize("keys", [[("a",)], [("a",), ("b", "c")]])
def test_same_as_without_an_index(spark, tmp_path, keys):
    rng = random.Random(4)
    stored, rows = random_rows(rng, 30, 20), random_rows(rng, 60, 40, start=1000)
    held = frame(spark, stored)
    indexes = {key: key_index.open_index(held, str(tmp_path), key, parts=5) for key in keys}
    accepted = inserts.insert_or_ignore(held, frame(spark, rows), keys, ["n"], indexes=indexes)
    assert sorted(repr(tuple(r)) for r in accepted.collect()) == one_by_one(stored, rows, keys)


def test_append_keeps_the_index(spark, tmp_path):
    catalog.create_database(spark, "index_test", str(tmp_path / "db"), replace=True)
    catalog.create_tables(spark, "index_test")
    name, root = "index_test.engineer", str(tmp_path / "index")
    try:
        for n, added in ((50, 50), (50, 0), (60, 10)):
            rows = generate.engineers(generate.ids(spark, n))
            assert inserts.append_or_ignore(
                spark, model.ENGINEER, name, rows, ["engineer_id"], index_root=root
            ) == added
        keys = spark.read.parquet(f"{root}/engineer_id/keys")
        assert keys.count() == spark.table(name).count() == 60
        assert spark.read.parquet(f"{root}/engineer_id/noted").first()["rows"] == 60
    finally:
        catalog.drop_database(spark, "index_test")
