from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from linewarden import model
from linewarden.operators import generate, linking
from linewarden.plans.jobs import NetworkSizes, seed_network
from linewarden.sources.catalog import create_database, create_tables, drop_database


@pytest.fixture(scope="module")
def parents(spark):
    """Ids with gaps, a null and a repeated one, in no order."""
    rows = [(i * 37 + 1000,) for i in range(50)][::-1] + [(None,), (1000,)]
    return spark.createDataFrame(rows, "id long").repartition(7)


def test_round_robin_over_ids_with_gaps(spark, parents):
    children = spark.createDataFrame([(f"C-{i * i:05d}",) for i in range(120)] + [(None,)], "c string")
    linked = linking.round_robin(children, "c", linking.keys_of(parents, "id"), "parent")
    rows = sorted(linked.collect())
    assert [r["link_id"] for r in rows] == list(range(1, 121))
    assert [r["c"] for r in rows] == [f"C-{i * i:05d}" for i in range(120)]
    assert [r["parent"] for r in rows] == [1000 + 37 * (i % 50) for i in range(120)]


def test_draws_take_every_id_about_equally_and_repeat(spark, parents):
    rows = spark.range(20_000)
    keys = linking.keys_of(parents, "id")
    drawn = [r["p"] for r in linking.draw_key(rows, "id", keys, "p", "x").orderBy("id").collect()]
    again = linking.draw_key(rows.repartition(3), "id", keys, "p", "x").orderBy("id").collect()
    assert drawn == [r["p"] for r in again]
    counts = Counter(drawn)
    assert len(counts) == 50 and 300 < min(counts.values()) and max(counts.values()) < 500


def test_no_parents_give_null(spark, parents):
    keys = linking.keys_of(parents.limit(0), "id")
    rows = spark.range(3)
    assert {r["p"] for r in linking.draw_key(rows, "id", keys, "p", "x").collect()} == {None}
    assert linking.round_robin(rows, "id", keys, "p").count() == 3


def test_no_one_task_window(spark, parents):
    linked = linking.round_robin(parents, "id", linking.keys_of(parents, "id"), "parent")
    assert "Window" not in linked._jdf.queryExecution().executedPlan().toString()


def test_dense_ids_are_told_from_sparse_ones(spark, parents):
    assert linking.are_dense(spark.range(1, 10), "id")
    assert linking.are_dense(spark.range(0), "id")
    assert not linking.are_dense(spark.range(0, 10), "id")
    assert not linking.are_dense(parents, "id")


def test_seeding_links_to_stored_rows_with_gaps(spark, tmp_path):
    """Towers that were there before, under ids far apart, get their incidents too."""
    sizes = NetworkSizes(towers=4, engineers=5, incidents=200, outages=20)
    create_database(spark, "sparse_test", f"file://{tmp_path}/db", replace=True)
    create_tables(spark, "sparse_test")
    far = generate.towers(generate.ids(spark, 9), seed=3).withColumns(
        {
            "tower_id": F.col("tower_id") * 1000,
            "tower_code": F.concat(F.lit("FAR-"), F.col("tower_id").cast("string")),
        }
    )
    columns = [c.name for c in model.TABLES["tower"].columns]
    from linewarden.sources.catalog import with_defaults

    for name in ("province", "carrier"):
        lookup = with_defaults(model.lookup(spark, name), model.TABLES[name])
        lookup.write.insertInto(f"sparse_test.{name}")
    with_defaults(far, model.TABLES["tower"]).select(*columns).write.insertInto("sparse_test.tower")
    try:
        run = seed_network(spark, "sparse_test", sizes=sizes)
        towers = {r["tower_id"] for r in run.tables["tower"].collect()}
        used = {r["tower_id"] for r in run.tables["outage_incident"].collect()}
        assert towers == {1, 2, 3, 4} | {1000 * i for i in range(1, 10)}
        assert used == towers
        assert sum(seed_network(spark, "sparse_test", sizes=sizes).rows_added.values()) == 0
    finally:
        drop_database(spark, "sparse_test")
