from __future__ import annotations

from pyspark.sql import functions as F

from linewarden.operators.numbering import number_rows


def test_numbers_are_dense_in_order_over_many_partitions(spark):
    keys = spark.range(0, 5000, 7, 13).select(F.concat(F.lit("K"), F.hex(F.xxhash64("id"))).alias("key"))
    numbered, count = number_rows(keys, ["key"])
    rows = [(r["number"], r["key"]) for r in numbered.collect()]
    assert count == len(rows) == keys.count()
    assert sorted(rows) == list(enumerate(sorted(k for _, k in rows), start=1))


def test_null_keys_ties_and_clashing_names(spark):
    frame = spark.createDataFrame(
        [(None, 1), ("a", 2), ("a", 3), ("b", 4)], "key string, number int"
    )
    numbered, count = number_rows(frame, ["key"], first=10)
    assert count == 4 and numbered.columns == ["key", "number"]
    assert sorted(r["number"] for r in numbered.collect()) == [10, 11, 12, 13]
    assert numbered.filter("key is null").first()["number"] == 10


def test_empty_table_has_no_numbers(spark):
    numbered, count = number_rows(spark.range(0).toDF("key"), ["key"])
    assert count == 0 and numbered.count() == 0


def test_no_window(spark):
    numbered, _ = number_rows(spark.range(100).toDF("key"), ["key"])
    assert "Window" not in numbered._jdf.queryExecution().executedPlan().toString()
