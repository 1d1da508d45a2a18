"""Properties of the generated data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linewarden import model
from linewarden.functions.draws import Draws, draw
from linewarden.operators import generate
from linewarden.operators.logs import parse_logs
from linewarden.operators.quality import validate_model

N = 3000


@pytest.fixture(scope="module")
def tables(spark):
    ids = generate.ids(spark, N)
    made = {name: model.lookup(spark, name) for name in model.LOOKUPS}
    made["tower"] = generate.towers(generate.ids(spark, 200))
    made["engineer"] = generate.engineers(generate.ids(spark, 20))
    made["outage_incident"] = generate.incidents(ids, 200)
    made["incident_assignment"] = generate.assignments(ids, 20)
    made["resolution_log"] = generate.resolutions(ids, 20)
    made["extract_link"] = generate.links(generate.ids(spark, 2 * N), N, "2025-01-01")
    return made


def test_known_draw(spark):
    value = F.conv(F.substring(F.md5(F.lit("7:12")), 1, 8), 16, 10)
    assert spark.range(1).select(value).first()[0] == "3526241513"
    drawn = spark.range(12, 13).select(draw(7, "x", F.col("id"))).first()[0]
    assert 0 <= drawn < 2**32


def test_same_values_in_any_partitioning(spark):
    few = spark.range(1, 501, 1, 1)
    many = spark.range(1, 501, 1, 1).repartition(7, F.col("id") % 5)
    for make in (
        generate.outage_records,
        generate.towers,
        generate.engineers,
        lambda ids: generate.incidents(ids, 9),
        lambda ids: generate.assignments(ids, 9),
        lambda ids: generate.resolutions(ids, 9),
    ):
        assert sorted(map(repr, make(few).collect())) == sorted(map(repr, make(many).collect()))


def test_generators_do_not_shuffle(spark, tables):
    for name in ("tower", "engineer", "outage_incident", "incident_assignment", "resolution_log"):
        assert "Exchange" not in tables[name]._jdf.queryExecution().executedPlan().toString()


def test_every_declared_rule_holds(tables):
    broken = validate_model(tables).filter("violations > 0").collect()
    assert broken == []


def test_one_lead_and_distinct_crew(tables):
    crew = tables["incident_assignment"].groupBy("incident_id").agg(
        F.count("*").alias("n"),
        F.countDistinct("engineer_id").alias("engineers"),
        F.sum(F.when(F.col("role") == "LEAD", 1).otherwise(0)).alias("leads"),
    )
    assert crew.filter("leads <> 1 or n <> engineers or n > 3").count() == 0
    sizes = {r.n: r["count"] for r in crew.groupBy("n").count().collect()}
    assert set(sizes) == {1, 2, 3} and sum(sizes.values()) == N
    # A third of the incidents draw each crew size; with 20 engineers repeats shrink some.
    assert 0.25 * N < sizes[3] < 0.36 * N < sizes[2] + sizes[1]


def test_ranges_and_shares(spark, tables):
    records = generate.outage_records(generate.ids(spark, N))
    row = records.agg(
        F.min("duration_min").alias("shortest"),
        F.percentile_approx("duration_min", 0.5).alias("median"),
        F.avg(F.log(F.col("duration_min"))).alias("mu"),
        F.min("customers_affected").alias("fewest"),
        F.max("customers_affected").alias("most"),
        F.min("onset_dt").alias("first"),
        F.max("onset_dt").alias("last"),
        F.countDistinct("outage_id").alias("ids"),
        F.countDistinct("province", "outage_type", "carrier").alias("kinds"),
    ).first()
    assert row.shortest == 15 and row.ids == N and row.kinds == 360
    assert 82 < row.median < 99 and 4.45 < row.mu < 4.65
    assert 50 <= row.fewest < 200 and 79_800 < row.most <= 80_000
    assert str(row.first) >= "2022-01-01" and str(row.last) < "2024-01-02"

    incidents = tables["outage_incident"]
    counts = incidents.groupBy("severity_id").count().collect()
    shares = {r.severity_id: r["count"] / N for r in counts}
    for severity, share in {1: 0.05, 2: 0.20, 3: 0.50, 4: 0.25}.items():
        assert abs(shares[severity] - share) < 0.03
    assert abs(incidents.filter("is_escalated").count() / N - 0.28) < 0.03
    assert incidents.filter("resolved_at is null or duration_min < 15").count() == 0
    oncall = generate.engineers(generate.ids(spark, N)).filter("is_oncall").count() / N
    assert abs(oncall - 0.25) < 0.03
    tower = tables["tower"].agg(
        *[f(c).alias(f"{c}_{n}") for c in ("latitude", "longitude")
          for n, f in (("min", F.min), ("max", F.max))]
    ).first()
    assert 42 <= tower.latitude_min <= tower.latitude_max <= 60
    assert -140 <= tower.longitude_min <= tower.longitude_max <= -52


def test_codes_grow_past_four_digits(spark):
    codes = generate.outage_records(spark.range(9999, 10002)).select("outage_id").collect()
    assert [r.outage_id for r in codes] == ["OUT-9999", "OUT-10000", "OUT-10001"]


def test_generated_logs_parse(spark):
    outages = generate.outage_records(generate.ids(spark, N))
    parsed = parse_logs(generate.incident_logs(outages))
    row = parsed.agg(
        F.count("*").alias("n"),
        F.sum((F.col("engineer_name") == "Unknown").cast("int")).alias("unknown"),
        F.avg(F.col("is_escalation").cast("int")).alias("escalated"),
        F.avg(F.col("log_duration_min").isNotNull().cast("int")).alias("timed"),
        F.min("log_duration_min").alias("low"),
        F.max("log_duration_min").alias("high"),
    ).first()
    assert row.n == N and row.unknown == 0
    assert 0.2 < row.escalated < 0.3 and 0.45 < row.timed < 0.55
    assert 30 <= row.low and row.high <= 480


def test_links_go_round(tables):
    per_incident = tables["extract_link"].groupBy("incident_id").count()
    assert per_incident.filter("count <> 2").count() == 0
    assert per_incident.count() == N


def test_weighted_edges(spark):
    d = Draws(1, F.col("id"))
    seen = spark.range(2000).select(d.weighted("w", {10: 1, 20: 0, 30: 3}).alias("w"))
    shares = {r.w: r["count"] for r in seen.groupBy("w").count().collect()}
    assert set(shares) == {10, 30} and 400 < shares[10] < 600


def test_parents_beyond_the_first_2_to_the_32_get_children(spark):
    parents = 2**40
    ids = generate.ids(spark, 2000)
    drawn = generate.incidents(ids, parents).agg(F.max("tower_id"), F.min("tower_id")).first()
    assert 0.99 * parents < drawn[0] <= parents and 1 <= drawn[1] < 0.01 * parents
    for rows, column in (
        (generate.assignments(ids, parents), "engineer_id"),
        (generate.resolutions(ids, parents), "performed_by"),
    ):
        assert rows.agg(F.max(column)).first()[0] > 2**32
