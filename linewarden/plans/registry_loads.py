"""Registered queries about loading: numbering, linking, reading, inserting, publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from linewarden import lens, model
from linewarden.functions.times import column_format
from linewarden.operators import linking
from linewarden.operators.clean import clean_outages
from linewarden.operators.quality import union_all
from linewarden.plans import dashboard, outage_reports
from linewarden.plans.jobs import run_extract
from linewarden.plans.registry import query, weighed
from linewarden.session import materialize, scratch_path
from linewarden.sources.catalog import create_database, create_tables
from linewarden.sources.inserts import append_or_ignore
from linewarden.sources.key_index import key_of_indexed, open_index
from linewarden.sources.publish import published
from linewarden.sources.typed import read_csv_typed


@query
def links_any_keys(spark, sf_dir):
    """Outage ids of the raw records, which have gaps, dealt over incident references."""
    incidents = linking.keys_of(lens.outage_incident(spark, sf_dir), "incident_ref")
    return linking.round_robin(
        lens.outage_raw(spark, sf_dir), "outage_id", incidents, "incident_ref"
    )


@query
def draws_any_keys(spark, sf_dir):
    """For every incident one of the engineers, drawn by their employee numbers."""
    engineers = linking.keys_of(lens.engineer(spark, sf_dir), "employee_no")
    incidents = lens.outage_incident(spark, sf_dir).select("incident_id")
    return linking.draw_key(incidents, "incident_id", engineers, "performed_by", "performer")


@query
def numbered_codes(spark, sf_dir):
    """Codes for all events by their place in time."""
    events = lens.table(spark, sf_dir, "events").select("event_id", "ts")
    return linking.numbered_codes(events, ["ts", "event_id"], "EVT-", "event_code").select(
        "event_id", "event_code"
    )


def _run(spark, sf_dir):
    """An extract run into a database and folders of its own; the folder it publishes to."""
    folder = scratch_path(spark, "run")
    database = "linewarden_" + folder.split("/")[-2]
    create_database(spark, database, f"{folder}/database")
    raw, logs = lens.outage_raw(spark, sf_dir), lens.incident_logs(spark, sf_dir)
    publish_to = f"{folder}/published"
    return run_extract(raw, logs, f"{folder}/extract", database, publish_to), publish_to


@query
def run_metrics(spark, sf_dir):
    """The counts of an extract run, taken by the passes that write."""
    return _run(spark, sf_dir)[0].metrics


@query
def published_logs(spark, sf_dir):
    """The logs as they were published together with the extract."""
    _, folder = _run(spark, sf_dir)
    return published(spark, folder)["incident_logs"]


@query
def published_events(spark, sf_dir):
    """The extract as it was published together with the logs."""
    _, folder = _run(spark, sf_dir)
    return published(spark, folder)["outage_events"]


@query
def reports_one_scan(spark, sf_dir):
    """The four grouped reports and the key metrics from one pass, row by row."""
    groups = materialize(outage_reports.report_groups(weighed(spark, sf_dir)), "report_groups")
    reports = outage_reports.reports_of_groups(groups)
    reports["key_metrics"] = dashboard.key_metrics_of_groups(groups)
    fields = {
        "outages_by_province": ("province", "total_outages", "avg_duration_min",
                                "total_customers_hit"),
        "worst_outage_types": ("outage_type", "incidents", "avg_duration_min", "avg_customers"),
        "escalation_rate_by_carrier": ("carrier", "total", "escalation_pct", "escalations"),
        "monthly_trend": (F.concat_ws("-", "year", "month"), "outages", F.lit(None),
                          "customers_affected"),
        "key_metrics": ("worst_province", "total_outages", "avg_duration_min",
                        "total_customers"),
    }
    return union_all(
        [
            reports[name].select(
                F.lit(name).alias("report"),
                _column(key).alias("key"),
                _column(rows).cast("bigint").alias("outages"),
                _column(mean).cast("double").alias("mean"),
                _column(total).cast("double").alias("total"),
            )
            for name, (key, rows, mean, total) in fields.items()
        ]
    )


def _column(value):
    return F.col(value) if isinstance(value, str) else value


@query
def dates_day_first(spark, sf_dir):
    """Dates written day first, most of which could be read month first too, some not at all."""
    event, stamp = F.col("event_id"), F.col("ts")
    raw = lens.table(spark, sf_dir, "events").select(
        lens.outage_id(event).alias("outage_id"),
        F.lit("on").alias("province"),
        F.when(event % 19 == 3, F.lit("unknown"))
        .otherwise(F.date_format(stamp, "d/M/yyyy HH:mm"))
        .alias("onset_dt"),
    )
    return clean_outages(raw, column_format(raw, "onset_dt").name)


def _typed_csv(spark, sf_dir):
    """Records as CSV with fractions, values that do not fit and lines that are cut short."""
    event, minutes = F.col("event_id"), 15 + F.col("event_id") % 400
    fields = [
        lens.outage_id(event),
        F.when(event % 7 == 2, F.lit("N/A")).otherwise(F.lit("ON")),
        F.when(event % 4 == 0, F.concat(minutes.cast("string"), F.lit(".5")))
        .when(event % 31 == 5, F.lit("two hours"))
        .otherwise(minutes.cast("string")),
        F.when(event % 17 == 4, F.lit("soon")).otherwise(
            F.date_format(F.col("ts"), "dd-MM-yyyy HH:mm")
        ),
        F.when(event % 29 == 6, F.lit("1e30")).otherwise(F.concat(event.cast("string"), F.lit(".0"))),
    ]
    header = "outage_id,province,duration_min,onset_dt,customers_affected"
    lines = lens.table(spark, sf_dir, "events").select(
        F.when(event % 101 == 50, F.concat_ws(",", *fields[:3]))
        .otherwise(F.concat_ws(",", *fields))
        .alias("line")
    )
    path = scratch_path(spark, "typed_csv")
    # A file per partition, each of which needs the header; so all lines go below one name.
    lines.withColumnRenamed("line", header).write.csv(
        path, header=True, quote="", sep="\x01", emptyValue=""
    )
    return read_csv_typed(spark, path)


@query
def csv_typed(spark, sf_dir):
    """Every record that could be split, typed by column: fractions kept, misfits null."""
    return _typed_csv(spark, sf_dir).rows


@query
def csv_rejects(spark, sf_dir):
    """The values that did not fit, one row each; a record cut short is one as a whole."""
    rejects = _typed_csv(spark, sf_dir).rejects
    return rejects.select(F.inline("rejected")).groupBy("column", "value", "type").agg(
        F.count("*").alias("records")
    )


@query
def append_with_index(spark, sf_dir):
    """Engineers appended to a table in two batches, stored keys read from its key indexes."""
    folder = scratch_path(spark, "indexed")
    database = "linewarden_" + folder.split("/")[-2]
    create_database(spark, database, f"{folder}/database")
    create_tables(spark, database)
    name = f"{database}.engineer"
    rows = lens.bad_engineer(spark, sf_dir).drop("phone", "province_code")
    for _ in range(2):
        append_or_ignore(
            spark, model.ENGINEER, name, rows, ["engineer_id"], index_root=f"{folder}/index"
        )
    return spark.table(name).select(
        "engineer_id", "employee_no", "full_name", "email", "is_oncall"
    )


@query
def key_lookup_indexed(spark, sf_dir):
    """Tower ids by tower code for every incident, from an index that carries them."""
    towers = lens.tower(spark, sf_dir)
    index = open_index(towers, scratch_path(spark, "index"), ("tower_code",), ("tower_id",), 16)
    asked = (
        lens.outage_incident(spark, sf_dir)
        .select("incident_ref", "tower_id")
        .join(towers.select("tower_id", "tower_code"), "tower_id")
        .select("incident_ref", "tower_code")
    )
    return key_of_indexed(asked, towers, index)
