"""The extract join and the plans behind it."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from linewarden import lens
from linewarden.operators.clean import clean_outages
from linewarden.operators.extract import build_extract, longest_outages, weighed_outages
from linewarden.operators.joins import left_join
from linewarden.operators.logs import parse_logs
from linewarden.plans import network_reports, outage_reports
from linewarden.plans.registry import QUERIES


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_left_join_equals_sparks_left_join(spark):
    left = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 3), (None, 4), ("c", 5)], "k string, v int"
    )
    right = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("c", None), (None, "z"), ("d", "w")], "k string, w string"
    )
    ours = sorted(map(repr, left_join(left, right, "k").select("k", "v", "w").collect()))
    theirs = sorted(map(repr, left.join(right, "k", "left").select("k", "v", "w").collect()))
    assert ours == theirs


def test_extract_shuffles_the_outages_once(spark, sf_dir):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = final_plan(QUERIES["build_extract"](spark, sf_dir))
    assert "ReusedExchange" in plan
    assert plan.count("SortMergeJoin") == 2


def test_hot_log_key_is_split(spark):
    """A third of all logs belong to one outage: the join splits that partition."""
    outages = spark.range(3000).select(
        F.concat(F.lit("OUT-"), F.col("id").cast("string")).alias("outage_id"),
        F.col("id").alias("v"),
    )
    hot = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 3500)
    logs = spark.range(0, 60000, 1, 8).select(
        F.concat(F.lit("OUT-"), hot.cast("string")).alias("outage_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("log_text"),
    )
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
    ):
        joined = left_join(outages, logs, "outage_id")
        plan = final_plan(joined)
        expected = outages.join(logs, "outage_id", "left").count()
        assert joined.count() == expected
    assert "skew=true" in plan


def test_no_report_uses_python_workers_or_cross_joins(spark, sf_dir):
    for name in ("build_extract", "key_metrics", "engineer_workload", "incident_summary"):
        plan = final_plan(QUERIES[name](spark, sf_dir))
        for operator in ("ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "NestedLoop"):
            assert operator not in plan, (name, operator)


def test_incidents_are_summed_before_the_tower_join(spark, sf_dir):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = final_plan(
            network_reports.incidents_by_province(
                lens.outage_incident(spark, sf_dir), lens.tower(spark, sf_dir)
            )
        )
    join = plan[plan.index("SortMergeJoin") :]
    assert "partial_sum" in join


def test_null_resolution_filter_reaches_the_scan(spark, tmp_path, sf_dir):
    path = str(tmp_path / "incidents")
    lens.outage_incident(spark, sf_dir).write.parquet(path)
    incidents = spark.read.parquet(path)
    plan = final_plan(network_reports.sla_compliance_resolved(incidents))
    assert "IsNotNull(resolved_at)" in plan
    assert "ReadSchema: struct<severity_id:int,resolved_at:timestamp_ntz,duration_min:int>" in plan


def test_top10_with_duplicate_and_missing_logs(spark):
    outages = spark.createDataFrame(
        [(f"OUT-{i:02d}", "ON", "C", "Bell", "Weather", d, 5) for i, d in
         enumerate([9, 9, 9, 8, 7, 6, 5, 4, 3, 2, 1, None])],
        "outage_id string, province string, city string, carrier string, outage_type string, "
        "duration_min bigint, customers_affected bigint",
    )
    logs = parse_logs(
        spark.createDataFrame(
            [("OUT-01", f"Technician Anna Smith{c} left") for c in "abc"] + [("OUT-03", "x")],
            "outage_id string, log_text string",
        )
    )
    clean = clean_outages(outages)
    whole = outage_reports.top10_longest_outages(build_extract(clean, logs)).collect()
    early = outage_reports.top10_longest_outages(longest_outages(clean, logs)).collect()
    assert whole == early
    assert [r.outage_id for r in whole][:5] == ["OUT-00", "OUT-01", "OUT-01", "OUT-01", "OUT-02"]


def test_reports_join_once(spark, sf_dir):
    """Logs are counted per outage first: one join, and each side is read once."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = final_plan(QUERIES["outages_by_province"](spark, sf_dir))
    assert plan.count("SortMergeJoin") == 1
    assert plan.count("FileScan parquet") == 2
    assert plan.count("regexp_extract") == 0


def test_weighed_outages_give_the_reports_of_the_extract(spark, sf_dir):
    outages = clean_outages(lens.outage_raw(spark, sf_dir))
    logs = parse_logs(lens.incident_logs(spark, sf_dir))
    whole, weighed = build_extract(outages, logs), weighed_outages(outages, logs)
    assert weighed.count() < whole.count()
    for name, report in outage_reports.OUTAGE_REPORTS.items():
        if name != "top10_longest_outages":
            assert report(whole).collect() == report(weighed).collect()


def test_each_log_pattern_runs_once(spark, sf_dir):
    plan = final_plan(QUERIES["parse_logs"](spark, sf_dir))
    assert plan.count("regexp_extract(") == 4


def test_top10_reads_the_logs_once(spark, sf_dir):
    plan = final_plan(QUERIES["top10_longest_outages"](spark, sf_dir))
    assert plan.count("FileScan parquet") <= 3
    link_plan = final_plan(QUERIES["extract_link_join"](spark, sf_dir))
    assert "TakeOrderedAndProject(limit=10, orderBy=[outage_id" in link_plan
