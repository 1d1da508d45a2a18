"""Figures known for the test tables at sf0.01, taken from the DuckDB statements."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linewarden import lens
from linewarden.plans.registry import QUERIES

SF = "/root/testdata/sf0.01"


def run(spark, name):
    return [tuple(r) for r in QUERIES[name](spark, SF).collect()]


def test_load_counts(spark):
    counts = {(r.step, r.metric): r.value for r in QUERIES["extract_metrics"](spark, SF).collect()}
    assert counts == {
        ("outages", "rows_loaded"): 10000,
        ("outages", "rows_dropped"): 201,
        ("logs", "rows_loaded"): 10000,
        ("logs", "escalations_flagged"): 2500,
        ("extract", "rows"): 10416,
        ("extract", "columns"): 15,
    }


def test_extract_gaps_and_names(spark):
    extract = QUERIES["build_extract"](spark, SF).cache()
    assert extract.filter("onset_dt is null").count() == 119
    assert extract.filter("log_text is null").count() == 1509
    counts = extract.groupBy("engineer_name").count().collect()
    names = {r.engineer_name: r["count"] for r in counts}
    extract.unpersist()
    assert names == {
        "Anna Smith": 1277,
        "John Doe": 1257,
        "Luc Roy": 1303,
        "Mary Ann Jones": 1321,
        "Unknown": 3749,
        None: 1509,
    }


def test_reports(spark):
    assert sorted(run(spark, "escalation_rate_by_carrier")) == [
        ("Bell", 1727, 381, 22.1),
        ("Rogers", 1751, 385, 22.0),
        ("SaskTel", 1777, 372, 20.9),
        ("Shaw", 1752, 375, 21.4),
        ("Telus", 1737, 361, 20.8),
        ("Videotron", 1672, 352, 21.1),
    ]
    assert run(spark, "worst_outage_types") == [
        ("Power failure", 1734, 3104.6, 40107.0),
        ("Software bug", 1738, 3022.7, 39704.0),
        ("Fibre cut", 1736, 3011.1, 40004.0),
        ("Planned maintenance", 1736, 2914.7, 39724.0),
        ("Hardware fault", 1736, 2898.9, 39906.0),
        ("Weather", 1736, 2836.3, 39672.0),
    ]
    assert run(spark, "outages_by_province")[0] == ("BC", 1090, 2930.3, 43111286)
    trend = run(spark, "monthly_trend")
    assert len(trend) == 25
    assert trend[-1][:3] == (None, None, 119)
    assert [row[0] for row in run(spark, "top10_longest_outages")] == [
        f"OUT-{i:04d}" for i in (10, 230, 266, 290, 700, 1039, 1286, 1394, 1474, 1474)
    ]


def test_key_metrics(spark):
    (row,) = run(spark, "key_metrics")
    assert row[:2] == (10416, 415107138)
    assert row[2] == pytest.approx(2964.7167, abs=1e-4)
    assert row[3] == "BC"


def test_network(spark):
    assert run(spark, "sla_compliance_all")[0][2:] == (2978, 87, 2.9)
    assert run(spark, "sla_compliance_resolved")[0][2:] == (1976, 87, 4.4)
    workload = QUERIES["engineer_workload"](spark, SF)
    assert workload.count() == 750
    first = workload.filter("employee_no = 'EMP-000000001'").first()
    assert tuple(first)[3:] == (113, 20, 4267830, 3044.2)
    assert lens.incident_assignment(spark, SF).count() == 59837
    assert lens.resolution_log(spark, SF).count() == 47174
    assert QUERIES["incident_summary"](spark, SF).count() == 15000
    # Links without an incident drop out.
    assert QUERIES["linked_incidents"](spark, SF).count() == 9473


def test_planted_faults(spark):
    incidents = lens.bad_incident(spark, SF)
    found = {}
    for name in ("dq_primary_key", "dq_foreign_key", "dq_range", "dq_temporal", "dq_not_null"):
        summary = QUERIES[name](spark, SF).filter(F.col("table_name") == "bad_incident")
        found |= {(r.rule, r.subject): r.violations for r in summary.collect()}
    assert incidents.count() == 15000
    assert found[("primary_key_null", "incident_id")] == 16
    assert found[("primary_key_duplicate", "incident_id")] == 29
    assert found[("foreign_key", "tower_id")] == 72
    assert found[("check", "customers_not_negative")] == 50
    assert found[("check", "resolved_after_reported")] == 38
    assert found[("not_null", "tower_id")] == 48
