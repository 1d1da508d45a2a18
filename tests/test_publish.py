from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linewarden.operators import generate
from linewarden.operators.metrics import Counted
from linewarden.plans.jobs import run_extract
from linewarden.plans.outage_reports import report_groups
from linewarden.session import materialize
from linewarden.sources import catalog
from linewarden.sources.publish import NothingPublished, drop_old_versions, publish, published


def pair(spark, n):
    return {"events": spark.range(n).toDF("e"), "logs": spark.range(n).selectExpr("id AS l", "1 AS x")}


def counts(spark, root):
    return {name: df.count() for name, df in published(spark, root).items()}


def test_a_failure_between_the_writes_leaves_the_old_pair(spark, tmp_path):
    root = str(tmp_path / "root")
    with pytest.raises(NothingPublished):
        published(spark, root)
    written = publish(spark, root, pair(spark, 5))
    assert {n: df.count() for n, df in written.items()} == counts(spark, root)
    broken = pair(spark, 9)
    broken["logs"] = broken["logs"].select(F.raise_error(F.lit("lost")).alias("l"))
    with pytest.raises(Exception, match="lost"):
        publish(spark, root, broken)
    assert counts(spark, root) == {"events": 5, "logs": 5}
    assert len(list((tmp_path / "root" / "versions").iterdir())) == 1
    publish(spark, root, pair(spark, 7))
    assert counts(spark, root) == {"events": 7, "logs": 7}


def test_a_reader_keeps_its_version_until_it_is_dropped(spark, tmp_path):
    root = str(tmp_path / "root")
    publish(spark, root, pair(spark, 1))
    held = published(spark, root)
    publish(spark, root, pair(spark, 2))
    assert held["events"].count() == held["logs"].count() == 1
    publish(spark, root, pair(spark, 3))
    assert drop_old_versions(spark, root, keep=2) == 1
    assert counts(spark, root) == {"events": 3, "logs": 3}
    assert len(list((tmp_path / "root" / "versions").iterdir())) == 2


def test_inputs_are_read_once(spark, tmp_path):
    """Accumulators see each input row once in a whole extract run."""
    read = {name: spark.sparkContext.accumulator(0) for name in ("raw", "logs")}

    def watched(df, name):
        seen = read[name]

        def run(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return df.mapInArrow(run, df.schema)

    ids = generate.ids(spark, 500)
    records = materialize(generate.outage_records(ids), "raw")
    raw = records.withColumn("province", F.when(F.col("duration_min") > 20, F.col("province")))
    logs = materialize(generate.incident_logs(records), "logs")
    catalog.create_database(spark, "once_test", str(tmp_path / "db"), replace=True)
    try:
        run = run_extract(
            watched(raw, "raw"), watched(logs, "logs"), str(tmp_path / "extract"), "once_test"
        )
        shape = {(r.step, r.metric): r.value for r in run.metrics.collect()}
        assert read["raw"].value == read["logs"].value == 500
        dropped = raw.filter("province IS NULL").count()
        assert shape == {
            ("outages", "rows_loaded"): 500,
            ("outages", "rows_dropped"): dropped,
            ("logs", "rows_loaded"): 500,
            ("logs", "escalations_flagged"): logs.filter("log_text ILIKE '%escalat%'").count(),
            ("extract", "rows"): 500 - dropped,
            ("extract", "columns"): 15,
        }
    finally:
        catalog.drop_database(spark, "once_test")


def test_counts_of_no_rows(spark):
    counted = Counted()
    empty = spark.createDataFrame([], "outage_id string, province string")
    materialize(counted.on(empty, "none", {"rows": F.count("*"), "sum": F.sum(F.lit(1))}), "none")
    assert {r["metric"]: r["value"] for r in counted.rows(spark).collect()} == {"rows": 0, "sum": 0}


def test_reports_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "extract")
    extract = generate.outage_records(generate.ids(spark, 50)).selectExpr(
        "*", "2024 AS year", "1 AS month", "true AS is_escalation"
    )
    extract.write.parquet(path)
    plan = report_groups(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan
