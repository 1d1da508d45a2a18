"""Sources, sinks, catalog and the end-to-end jobs."""

from __future__ import annotations

import datetime as dt
from pathlib import Path
from urllib.parse import urlparse

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from linewarden import lens, model, session
from linewarden.operators import generate
from linewarden.operators.metrics import row_counts
from linewarden.plans import dashboard
from linewarden.plans.jobs import NetworkSizes, run_extract, seed_network
from linewarden.plans.outage_reports import run_outage_reports
from linewarden.sources import catalog, readers, writers


def test_csv_with_byte_order_mark_and_mixed_columns(spark, tmp_path):
    file = tmp_path / "outages.csv"
    file.write_bytes(
        "﻿province,outage_id,remark,duration_min,onset_dt\n"
        'MB,OUT-0001,"said ""hello"", twice",90,2022-05-01 10:00:00\n'
        "NA,OUT-0002,,n/a,soon\n"
        " on ,OUT-0003,x,12.5,2022-05-02\n"
        "QC,OUT-0004,,90.0,2022/03/05 10:11\n"
        "QC,OUT-0005,,-0.4,2022-05-01T10:00:00+05:00\n"
        "QC,OUT-0006,,1e3,5-Mar-2022 7:08\n"
        "QC,OUT-0007,,99999999999999999999,03/25/2022\n".encode()
    )
    df = readers.read_csv(spark, str(file))
    assert dict(df.dtypes)["duration_min"] == "bigint"
    rows = {r.outage_id: r for r in df.collect()}
    assert rows["OUT-0001"].province == "MB"
    assert rows["OUT-0001"].remark == 'said "hello", twice'
    assert rows["OUT-0001"].onset_dt == dt.datetime(2022, 5, 1, 10)
    assert tuple(rows["OUT-0002"]) == (None, "OUT-0002", None, None, None)
    assert rows["OUT-0003"].province == " on "
    assert rows["OUT-0003"].onset_dt == dt.datetime(2022, 5, 2)
    assert [rows[f"OUT-000{i}"].duration_min for i in (3, 4, 5, 6, 7)] == [13, 90, 0, 1000, None]
    assert [rows[f"OUT-000{i}"].onset_dt for i in (4, 5, 6, 7)] == [
        dt.datetime(2022, 3, 5, 10, 11),
        dt.datetime(2022, 5, 1, 5),
        dt.datetime(2022, 3, 5, 7, 8),
        dt.datetime(2022, 3, 25),
    ]


def test_quoted_line_break_is_read_or_refused(spark, tmp_path):
    file = tmp_path / "breaks.csv"
    file.write_text('outage_id,province,city\nOUT-1,"O\nN",x\nOUT-2,QC,y\n')
    rows = readers.read_csv(spark, str(file), multiline=True).collect()
    assert [tuple(r) for r in rows] == [("OUT-1", "O\nN", "x"), ("OUT-2", "QC", "y")]
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_csv(spark, str(file)).collect()
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.load_or_else(
            lambda: readers.read_csv(spark, str(file)), lambda: spark.range(1), required=()
        )


def test_failing_task_does_not_lead_to_the_fallback(spark):
    def primary():
        return spark.range(3).selectExpr("raise_error('task lost') AS outage_id", "1 AS province")

    with pytest.raises((PySparkException, Py4JJavaError), match="task lost"):
        readers.load_or_else(primary, lambda: spark.range(1))


def test_fallback(spark, tmp_path):
    def backup():
        return generate.outage_records(generate.ids(spark, 300))

    good = tmp_path / "good"
    backup().limit(5).write.csv(str(good), header=True)
    df, source, cause = readers.load_or_else(lambda: readers.read_csv(spark, str(good)), backup)
    assert (df.count(), source, cause) == (5, "primary", None)

    lacking = tmp_path / "lacking"
    backup().select("outage_id").write.csv(str(lacking), header=True)
    df, source, cause = readers.load_or_else(lambda: readers.read_csv(spark, str(lacking)), backup)
    assert (df.count(), source) == (300, "fallback") and "province" in cause

    missing = str(tmp_path / "no")
    df, source, cause = readers.load_or_else(lambda: readers.read_csv(spark, missing), backup)
    assert (df.count(), source) == (300, "fallback") and missing in cause

    broken = tmp_path / "broken.parquet"
    broken.write_bytes(b"not parquet at all")
    df, source, cause = readers.load_or_else(
        lambda: readers.read_parquet(spark, str(broken)), backup
    )
    assert (df.count(), source) == (300, "fallback") and cause

    with pytest.raises(ZeroDivisionError):
        readers.load_or_else(lambda: 1 / 0, backup)


def test_shared_folder_is_the_sessions(spark):
    assert session.shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    frame = spark.range(5).withColumn("x", F.lit("y"))
    again = session.materialize(frame, "frame")
    assert again.dtypes == frame.dtypes and again.count() == 5
    assert session.materialize(frame.limit(0), "empty").count() == 0


def test_without_a_setting_scratch_lies_below_the_warehouse():
    class Context:
        master = "local[4]"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {"spark.sql.warehouse.dir": "hdfs:/warehouse"}

    assert session.shared_folder(Session()) == "hdfs:/warehouse/scratch"
    Context.master = "spark://head:7077"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_scratch_of_a_scope_is_removed(spark):
    kept = session.materialize(spark.range(3), "kept")
    with session.scratch_scope(spark):
        with session.scratch_scope(spark):
            files = session.materialize(spark.range(3), "inner").inputFiles()
        files += session.materialize(spark.range(3), "outer").inputFiles()
        assert Path(urlparse(files[-1]).path).exists()
    assert not any(Path(urlparse(f).path).exists() for f in files)
    assert kept.count() == 3
    with pytest.raises(ValueError), session.scratch_scope(spark):
        lost = session.materialize(spark.range(3), "lost").inputFiles()
        raise ValueError
    assert not Path(urlparse(lost[0]).path).exists()


def test_incident_layout_prunes_months(spark, sf_dir, tmp_path):
    incidents = writers.write_incidents(lens.outage_incident(spark, sf_dir), str(tmp_path / "i"))
    month = incidents.filter("reported_year = 1995 and reported_month = 3")
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reported_year" in plan
    expected = lens.outage_incident(spark, sf_dir).filter(
        "year(reported_at) = 1995 and month(reported_at) = 3"
    )
    assert month.count() == expected.count() > 0


def test_defaults_fill_absent_columns_only(spark):
    rows = spark.createDataFrame([(1, None)], "incident_id bigint, customers_affected bigint")
    row = catalog.with_defaults(rows, model.OUTAGE_INCIDENT).first()
    assert row.customers_affected is None
    assert row.is_escalated is False
    assert row.created_at is not None and row.resolved_at is None
    assert list(row.asDict()) == [c.name for c in model.OUTAGE_INCIDENT.columns]


def test_extract_job(spark, sf_dir, tmp_path):
    catalog.create_database(spark, "extract_test", str(tmp_path / "db"), replace=True)
    spark.catalog.setCurrentDatabase("default")
    raw, logs = lens.outage_raw(spark, sf_dir), lens.incident_logs(spark, sf_dir)
    for _ in range(2):
        run = run_extract(raw, logs, str(tmp_path / "extract"), "extract_test")
    extract = run.tables["extract"]
    assert spark.table("extract_test.outage_events").count() == extract.count()
    assert spark.table("extract_test.incident_logs").columns == ["outage_id", "log_text"]
    assert set(run.reports) == {
        "outages_by_province",
        "worst_outage_types",
        "escalation_rate_by_carrier",
        "monthly_trend",
        "top10_longest_outages",
    }
    rows = {r.name: r.row_count for r in run.report_rows.collect()}
    assert rows["top10_longest_outages"] == 10 and rows["worst_outage_types"] == 6
    shape = {(r.step, r.metric): r.value for r in run.metrics.collect()}
    assert shape[("extract", "rows")] == extract.count()
    for panel in run.panels.values():
        assert panel.count() > 0
    separate = run_outage_reports(extract)
    for name, report in separate.items():
        assert run.reports[name].columns == report.columns
        assert run.reports[name].collect() == report.collect(), name
    assert run.panels["key_metrics"].collect() == dashboard.key_metrics(extract).collect()
    plan = separate["outages_by_province"]._jdf.queryExecution().executedPlan().toString()
    assert (
        "ReadSchema: struct<province:string,duration_min:bigint,customers_affected:bigint>" in plan
    )


def test_network_job_is_idempotent(spark, tmp_path):
    sizes = NetworkSizes(towers=20, engineers=10, incidents=40, outages=100)
    location = str(tmp_path / "net")
    first = seed_network(spark, "network_test", location, sizes, replace=True)
    assert first.rows_added["tower"] == 20
    assert first.rows_added["extract_link"] == 100
    assert 40 <= first.rows_added["incident_assignment"] <= 120
    offered = {r.name: r.row_count for r in first.rows_offered.collect()}
    assert offered == first.rows_added
    second = seed_network(spark, "network_test", location, sizes)
    assert set(second.rows_added.values()) == {0}
    counts = {r.name: r.row_count for r in row_counts(second.tables).collect()}
    assert counts == first.rows_added
    assert second.reports["extract_link_join"].count() == 10
    assert spark.sql("SELECT * FROM v_incident_summary").count() == 40
    assert "root_cause_notes" in spark.table("v_incident_summary").columns
    assert spark.sql("SELECT * FROM v_sla_compliance").count() <= 4
    spark.catalog.setCurrentDatabase("default")


def test_command_line(spark, tmp_path, capsys):
    from linewarden.__main__ import main

    catalog.create_database(spark, "command_test", str(tmp_path / "db"), replace=True)
    spark.catalog.setCurrentDatabase("default")
    outages = str(tmp_path / "outages")
    generate.outage_records(generate.ids(spark, 40)).write.csv(outages, header=True)
    out = str(tmp_path / "extract")
    main(["extract", "--outages", outages, "--out", out, "--database", "command_test"])
    printed = capsys.readouterr().out
    assert "primary source" in printed and "top10_longest_outages" in printed
    extract = readers.read_parquet(spark, out)
    assert extract.count() == 40
    assert extract.filter("log_text is null").count() == 0

    main(["extract", "--rows", "50", "--out", out, "--database", "command_test"])
    assert "generated source" in capsys.readouterr().out
    assert readers.read_table(spark, "command_test.outage_events").count() == 50

    lost = ["extract", "--outages", str(tmp_path / "lost"), "--rows", "7", "--out", out]
    with pytest.raises(AnalysisException):
        main(lost)
    main([*lost, "--database", "command_test", "--or-generate"])
    assert "fallback source" in capsys.readouterr().out
    assert readers.read_table(spark, "command_test.outage_events").count() == 7
