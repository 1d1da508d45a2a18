"""The registered queries: each reads the test tables through the lens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linewarden import lens, model
from linewarden.functions.times import minutes_between, timestamp_text
from linewarden.operators import generate, metrics, quality
from linewarden.operators.clean import clean_outages
from linewarden.operators.extract import build_extract, longest_outages, weighed_outages
from linewarden.operators.logs import parse_logs
from linewarden.plans import dashboard, network_reports, outage_reports
from linewarden.session import materialize, scratch_path
from linewarden.sources import catalog, inserts, readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_outages(lens.outage_raw(spark, sf_dir))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_logs(lens.incident_logs(spark, sf_dir))


def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_extract(outages(spark, sf_dir), logs(spark, sf_dir))


def weighed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the reports without log texts read."""
    return weighed_outages(outages(spark, sf_dir), logs(spark, sf_dir))


QUERIES["parse_logs"] = logs
QUERIES["clean_outages"] = outages
QUERIES["build_extract"] = extract


@query
def outages_by_province(spark, sf_dir):
    return outage_reports.outages_by_province(weighed(spark, sf_dir))


@query
def worst_outage_types(spark, sf_dir):
    return outage_reports.worst_outage_types(weighed(spark, sf_dir))


@query
def escalation_rate_by_carrier(spark, sf_dir):
    return outage_reports.escalation_rate_by_carrier(weighed(spark, sf_dir))


@query
def monthly_trend(spark, sf_dir):
    return outage_reports.monthly_trend(weighed(spark, sf_dir))


@query
def top10_longest_outages(spark, sf_dir):
    longest = longest_outages(outages(spark, sf_dir), logs(spark, sf_dir), 10)
    return outage_reports.top10_longest_outages(longest)


@query
def incident_duration(spark, sf_dir):
    """Stored-duration rule on incidents whose resolution is seconds off a full minute."""
    incidents = lens.outage_incident(spark, sf_dir)
    seconds = F.expr("(incident_id % 60) * interval '1' second")
    resolved = F.col("resolved_at") + seconds
    return incidents.select(
        "incident_id",
        "reported_at",
        resolved.alias("resolved_at"),
        minutes_between(F.col("reported_at"), resolved).alias("duration_min"),
    )


@query
def incidents_by_province(spark, sf_dir):
    return network_reports.incidents_by_province(
        lens.outage_incident(spark, sf_dir), lens.tower(spark, sf_dir)
    )


@query
def engineer_workload_top10(spark, sf_dir):
    return network_reports.engineer_workload_top10(
        lens.engineer(spark, sf_dir),
        lens.incident_assignment(spark, sf_dir),
        lens.outage_incident(spark, sf_dir),
    )


@query
def engineer_workload(spark, sf_dir):
    return network_reports.engineer_workload(
        lens.engineer(spark, sf_dir),
        lens.incident_assignment(spark, sf_dir),
        lens.outage_incident(spark, sf_dir),
    )


@query
def sla_compliance_all(spark, sf_dir):
    return network_reports.sla_compliance_all(lens.outage_incident(spark, sf_dir))


@query
def sla_compliance_resolved(spark, sf_dir):
    return network_reports.sla_compliance_resolved(lens.outage_incident(spark, sf_dir))


@query
def incident_summary(spark, sf_dir):
    return network_reports.incident_summary(
        lens.outage_incident(spark, sf_dir), lens.tower(spark, sf_dir)
    )


@query
def linked_incidents(spark, sf_dir):
    return network_reports.linked_incidents(
        lens.extract_link(spark, sf_dir),
        lens.outage_incident(spark, sf_dir),
        lens.tower(spark, sf_dir),
    )


@query
def extract_link_join(spark, sf_dir):
    return network_reports.extract_link_join(
        lens.extract_link(spark, sf_dir),
        lens.outage_incident(spark, sf_dir),
        lens.tower(spark, sf_dir),
    )


@query
def escalated_incidents(spark, sf_dir):
    return network_reports.escalated_incidents(lens.outage_incident(spark, sf_dir))


@query
def panel_province(spark, sf_dir):
    return dashboard.panel_province(outages_by_province(spark, sf_dir))


@query
def panel_type_duration(spark, sf_dir):
    return dashboard.panel_type_duration(worst_outage_types(spark, sf_dir))


@query
def panel_escalation(spark, sf_dir):
    return dashboard.panel_escalation(escalation_rate_by_carrier(spark, sf_dir))


@query
def panel_trend(spark, sf_dir):
    return dashboard.panel_trend(monthly_trend(spark, sf_dir))


@query
def key_metrics(spark, sf_dir):
    return dashboard.key_metrics(weighed(spark, sf_dir))


@query
def metric_cards(spark, sf_dir):
    return dashboard.metric_cards(key_metrics(spark, sf_dir))


def model_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All tables of the model: lookups as they are, the others through the lens."""
    tables = {name: model.lookup(spark, name) for name in model.LOOKUPS}
    for name in (
        "tower",
        "engineer",
        "outage_incident",
        "incident_assignment",
        "resolution_log",
        "extract_link",
    ):
        tables[name] = getattr(lens, name)(spark, sf_dir)
    return tables


@query
def dq_primary_key(spark, sf_dir):
    keys = {
        "bad_incident": "incident_id",
        "resolution_log": "log_id",
        "tower": "tower_id",
        "engineer": "engineer_id",
    }
    return quality.union_all(
        [
            quality.check_keys(getattr(lens, name)(spark, sf_dir), name, primary_key=key)
            for name, key in keys.items()
        ]
    )


@query
def dq_unique(spark, sf_dir):
    keys = {
        "bad_engineer": (("employee_no",), ("email",)),
        "tower": (("tower_code",),),
        "outage_incident": (("incident_ref",),),
        "extract_link": (("outage_id",),),
    }
    return quality.union_all(
        [
            quality.check_keys(getattr(lens, name)(spark, sf_dir), name, unique=unique)
            for name, unique in keys.items()
        ]
    )


@query
def dq_composite_unique(spark, sf_dir):
    keys = {
        "bad_assignment": (("incident_id", "engineer_id"),),
        "resolution_log": (("incident_id", "action_id"),),
    }
    return quality.union_all(
        [
            quality.check_keys(getattr(lens, name)(spark, sf_dir), name, unique=unique)
            for name, unique in keys.items()
        ]
    )


@query
def dq_not_null(spark, sf_dir):
    required = {
        "bad_incident": (
            "incident_id",
            "tower_id",
            "severity_id",
            "reported_at",
            "customers_affected",
        ),
        "bad_engineer": ("engineer_id", "employee_no", "full_name", "email"),
        "bad_tower": ("tower_id", "site_type", "city"),
    }
    return quality.union_all(
        [
            quality.check_rows(
                getattr(lens, name)(spark, sf_dir), name, [quality.not_null(c) for c in columns]
            )
            for name, columns in required.items()
        ]
    )


@query
def dq_foreign_key(spark, sf_dir):
    incidents = lens.bad_incident(spark, sf_dir)
    assignments = lens.incident_assignment(spark, sf_dir)
    references = [
        (incidents, "bad_incident", "tower_id", lens.tower(spark, sf_dir), "tower_id"),
        (
            incidents,
            "bad_incident",
            "severity_id",
            model.lookup(spark, "severity_level"),
            "severity_id",
        ),
        (
            lens.bad_engineer(spark, sf_dir),
            "bad_engineer",
            "province_code",
            model.lookup(spark, "province"),
            "province_code",
        ),
        (assignments, "incident_assignment", "incident_id", incidents, "incident_id"),
        (
            assignments,
            "incident_assignment",
            "engineer_id",
            lens.engineer(spark, sf_dir),
            "engineer_id",
        ),
    ]
    return quality.union_all([quality.check_reference(*reference) for reference in references])


@query
def dq_domain(spark, sf_dir):
    return quality.union_all(
        [
            quality.check_rows(
                lens.bad_tower(spark, sf_dir),
                "bad_tower",
                [quality.in_domain("site_type", model.SITE_TYPES)],
            ),
            quality.check_rows(
                lens.bad_assignment(spark, sf_dir),
                "bad_assignment",
                [quality.in_domain("role", model.ROLES)],
            ),
        ]
    )


def _incident_check(spark, sf_dir, name):
    rule = quality.holds(name, model.OUTAGE_INCIDENT.checks[name])
    return quality.check_rows(lens.bad_incident(spark, sf_dir), "bad_incident", [rule])


@query
def dq_range(spark, sf_dir):
    return _incident_check(spark, sf_dir, "customers_not_negative")


@query
def dq_temporal(spark, sf_dir):
    return _incident_check(spark, sf_dir, "resolved_after_reported")


@query
def dq_length(spark, sf_dir):
    lengths = model.ENGINEER.lengths
    rules = [
        quality.max_length(c, lengths[c]) for c in ("employee_no", "full_name", "email", "phone")
    ]
    return quality.check_rows(lens.bad_engineer(spark, sf_dir), "bad_engineer", rules)


@query
def dq_decimal(spark, sf_dir):
    rules = [quality.fits_decimal(c, model.COORDINATE) for c in ("latitude", "longitude")]
    return quality.check_rows(lens.bad_tower(spark, sf_dir), "bad_tower", rules)


@query
def dq_derived(spark, sf_dir):
    derived = model.OUTAGE_INCIDENT.derived["duration_min"]()
    return quality.check_rows(
        lens.bad_incident(spark, sf_dir),
        "bad_incident",
        [quality.equals_derived("duration_min", derived)],
    )


@query
def dq_model(spark, sf_dir):
    """Every declared rule over every table of the model.

    Tables are checked where they lie. Only the two that are grouped out of the line items
    are written down first: several rules read them, and to group costs more than to write.
    """
    tables = model_tables(spark, sf_dir)
    for name in ("incident_assignment", "resolution_log"):
        tables[name] = materialize(tables[name], name)
    return quality.validate_model(tables)


@query
def dq_offending_rows(spark, sf_dir):
    """The incidents that break a single-row rule, with the rules they break."""
    incidents = lens.bad_incident(spark, sf_dir)
    rules = quality.row_rules(model.OUTAGE_INCIDENT, incidents.columns)
    return quality.offending_rows(incidents, rules)


@query
def dq_repeated_rows(spark, sf_dir):
    """The assignments that share their incident and engineer with another one."""
    return quality.repeated_rows(
        lens.bad_assignment(spark, sf_dir), ("incident_id", "engineer_id")
    )


@query
def dq_orphan_rows(spark, sf_dir):
    """The incidents whose tower does not exist."""
    return quality.orphan_rows(
        lens.bad_incident(spark, sf_dir), "tower_id", lens.tower(spark, sf_dir), "tower_id"
    )


@query
def extract_metrics(spark, sf_dir):
    return metrics.extract_metrics(
        lens.outage_raw(spark, sf_dir), lens.incident_logs(spark, sf_dir), extract(spark, sf_dir)
    )


@query
def table_row_counts(spark, sf_dir):
    return metrics.row_counts(model_tables(spark, sf_dir))


def _database(spark: SparkSession) -> tuple[str, str]:
    """Name and folder of a database of this run's own."""
    folder = scratch_path(spark, "database")
    return "linewarden_" + folder.split("/")[-2], folder


@query
def csv_source(spark, sf_dir):
    """Outage records written as CSV with a header and read back by column name."""
    path = scratch_path(spark, "outages_csv")
    lens.outage_raw(spark, sf_dir).write.csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return readers.read_csv(spark, path)


@query
def source_fallback(spark, sf_dir):
    """A primary source that does not exist, and the fallback used in its place."""
    missing = scratch_path(spark, "missing_csv")
    loaded = readers.load_or_else(
        lambda: readers.read_csv(spark, missing), lambda: lens.outage_raw(spark, sf_dir)
    )
    return loaded.df.withColumn("source", F.lit(loaded.source))


@query
def table_round_trip(spark, sf_dir):
    """The extract written as parquet and as a table, read back from the table."""
    database, folder = _database(spark)
    catalog.create_database(spark, database, folder)
    tables = writers.persist_extract(
        extract(spark, sf_dir), lens.incident_logs(spark, sf_dir), f"{folder}/extract", database
    )
    return tables["outage_events"]


@query
def incident_layout(spark, sf_dir):
    """Incidents written by month in report order, read back."""
    return writers.write_incidents(
        lens.outage_incident(spark, sf_dir), scratch_path(spark, "incidents")
    )


@query
def named_views(spark, sf_dir):
    """The rows of the model's views as text, through SQL."""
    views = network_reports.network_views(model_tables(spark, sf_dir))
    catalog.register_views(views)
    shown = {
        "v_incident_summary": (
            "incident_ref", "tower_code", "city", "province_code", "carrier_name",
            "outage_type", "severity", "duration_min", "customers_affected",
        ),
        "v_engineer_workload": (
            "employee_no", "total_incidents", "led_incidents", "total_customers_handled",
        ),
        "v_sla_compliance": ("severity", "sla_resolve_min", "total_incidents", "within_sla"),
        "v_escalated_incidents": ("incident_id", "tower_id", "severity_id"),
    }
    return spark.sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS view_name, concat_ws('|', {', '.join(shown[name])}) AS content "
            f"FROM {name}"
            for name in views
        )
    )


@query
def lookup_rows(spark, sf_dir):
    """Every lookup row as text, counted against the incidents that use it where any can."""
    rows = [
        model.lookup(spark, name).select(
            F.lit(name).alias("lookup"),
            F.concat_ws("|", *[F.coalesce(F.col(c.name).cast("string"), F.lit("-"))
                               for c in model.TABLES[name].columns
                               if c.name in model.lookup(spark, name).columns]).alias("content"),
            F.col(model.TABLES[name].primary_key).cast("string").alias("key"),
        )
        for name in model.LOOKUPS
    ]
    used = lens.outage_incident(spark, sf_dir).select(
        F.explode(
            F.array(
                F.struct(F.lit("outage_type").alias("lookup"),
                         F.col("outage_type_id").cast("string").alias("key")),
                F.struct(F.lit("severity_level").alias("lookup"),
                         F.col("severity_id").cast("string").alias("key")),
            )
        ).alias("u")
    )
    counts = used.groupBy("u.lookup", "u.key").agg(F.count("*").alias("n"))
    return (
        quality.union_all(rows)
        .join(counts, ["lookup", "key"], "left")
        .select("lookup", "content", F.coalesce("n", F.lit(0)).alias("incidents"))
    )


@query
def optional_columns(spark, sf_dir):
    """Cleaning of records that bring neither a date nor a duration."""
    return clean_outages(lens.outage_raw(spark, sf_dir).drop("onset_dt", "duration_min"))


@query
def report_order(spark, sf_dir):
    """The place of every row in the reports and panels, as they come out sorted."""
    by_province = outages_by_province(spark, sf_dir)
    by_type = worst_outage_types(spark, sf_dir)
    by_carrier = escalation_rate_by_carrier(spark, sf_dir)
    by_month = monthly_trend(spark, sf_dir)
    month = F.concat_ws("-", "year", "month")
    ordered = {
        "outages_by_province": by_province.select(F.col("province").alias("row")),
        "worst_outage_types": by_type.select(F.col("outage_type").alias("row")),
        "escalation_rate_by_carrier": by_carrier.select(F.col("carrier").alias("row")),
        "monthly_trend": by_month.select(month.alias("row")),
        "panel_province": dashboard.panel_province(by_province).select(
            F.col("province").alias("row")
        ),
        "panel_type_duration": dashboard.panel_type_duration(by_type).select(
            F.col("outage_type").alias("row")
        ),
        "panel_escalation": dashboard.panel_escalation(by_carrier).select(
            F.col("carrier").alias("row")
        ),
        "panel_trend": dashboard.panel_trend(by_month).select(
            F.coalesce("period", F.lit("")).alias("row")
        ),
    }
    # Ids grow along a sorted result; they are compared within one report only.
    return quality.union_all(
        [
            df.withColumn("id", F.monotonically_increasing_id()).select(
                F.lit(name).alias("report"),
                "row",
                F.row_number().over(Window.orderBy("id")).cast("bigint").alias("place"),
            )
            for name, df in ordered.items()
        ]
    )


@query
def append_into_table(spark, sf_dir):
    """Engineers with repeated numbers and e-mails appended to a catalog table, twice."""
    database, folder = _database(spark)
    catalog.create_database(spark, database, folder)
    catalog.create_tables(spark, database)
    rows = lens.bad_engineer(spark, sf_dir).drop("phone", "province_code")
    for _ in range(2):
        inserts.append_or_ignore(
            spark, model.ENGINEER, f"{database}.engineer", rows, ["engineer_id"]
        )
    return spark.table(f"{database}.engineer").select(
        "engineer_id", "employee_no", "full_name", "email", "is_oncall"
    )


@query
def csv_dirty_source(spark, sf_dir):
    """CSV as other tools write it: decimal texts for whole numbers, dates of several formats,
    quotes and commas in fields, markers for missing values; read back typed."""
    event, minutes = F.col("event_id"), 15 + F.col("event_id") % 400
    stamp = F.col("ts")
    written = lens.table(spark, sf_dir, "events").select(
        lens.outage_id(event).alias("outage_id"),
        F.when(event % 7 == 2, F.lit("N/A")).otherwise(F.lit("ON")).alias("province"),
        F.concat(F.lit('said "no", event '), event.cast("string")).alias("remark"),
        F.when(event % 4 == 0, F.concat(minutes.cast("string"), F.lit(".0")))
        .when(event % 4 == 1, F.concat(minutes.cast("string"), F.lit(".5")))
        .when(event % 4 == 2, F.lit("nan"))
        .otherwise(minutes.cast("string"))
        .alias("duration_min"),
        F.when(event % 3 == 0, F.date_format(stamp, "yyyy/M/d H:mm"))
        .when(event % 3 == 1, F.concat(timestamp_text(stamp), F.lit("+05:00")))
        .otherwise(F.lit("soon"))
        .alias("onset_dt"),
    )
    path = scratch_path(spark, "dirty_csv")
    written.write.csv(path, header=True, escape='"')
    return readers.read_csv(spark, path)


def _assignment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One assignment per line item, with the columns that order the lines."""
    engineers = lens.row_count(spark, sf_dir, "customer")
    line = F.col("l_linenumber")
    return lens.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") + 1).alias("incident_id"),
        (1 + F.col("l_partkey") % engineers).alias("engineer_id"),
        F.when(line == 1, "LEAD").otherwise("SUPPORT").alias("role"),
        F.col("l_shipdate").alias("assigned_at"),
        F.col("l_linestatus").alias("batch"),
        line.alias("line"),
    )


@query
def insert_ignore(spark, sf_dir):
    """Assignments of finished lines, then an insert of all lines on top of them."""
    key, arrival = [("incident_id", "engineer_id")], ["line"]
    rows = _assignment_rows(spark, sf_dir)
    finished = rows.filter(F.col("batch") == "F")
    stored = inserts.insert_or_ignore(rows.limit(0), finished, key, arrival)
    stored = materialize(stored, "assignments")
    added = inserts.insert_or_ignore(stored, rows, key, arrival)
    return stored.unionByName(added)


@query
def insert_ignore_two_keys(spark, sf_dir):
    """Resolutions from all line items under a primary key and a unique pair at once."""
    engineers = lens.row_count(spark, sf_dir, "customer")
    rows = lens.table(spark, sf_dir, "lineitem").select(
        lens.log_id(F.col("l_orderkey") + 1, F.col("l_linenumber")).alias("log_id"),
        (F.col("l_orderkey") + 1).alias("incident_id"),
        (1 + F.col("l_partkey") % 8).cast("int").alias("action_id"),
        (1 + F.col("l_suppkey") % engineers).alias("performed_by"),
        F.col("l_shipdate").alias("performed_at"),
    )
    return inserts.insert_or_ignore(
        rows.limit(0),
        rows,
        model.RESOLUTION_LOG.unique_keys,
        ["performed_at", "log_id", "action_id", "performed_by"],
    )


@query
def key_lookup(spark, sf_dir):
    """Tower ids found again by tower code for every incident; some codes do not exist."""
    towers = lens.tower(spark, sf_dir)
    wrong = F.concat(F.lit("NO-"), F.col("tower_code"))
    asked = (
        lens.outage_incident(spark, sf_dir)
        .select("incident_id", "incident_ref", "tower_id")
        .join(towers.select("tower_id", "tower_code"), "tower_id")
        .select(
            "incident_ref",
            F.when(F.col("incident_id") % 23 == 7, wrong)
            .otherwise(F.col("tower_code"))
            .alias("tower_code"),
        )
    )
    return inserts.key_of(asked, towers, ("tower_code",), "tower_id")


@query
def default_columns(spark, sf_dir):
    """Incidents without the optional columns, completed with the declared defaults."""
    bare = lens.outage_incident(spark, sf_dir).drop("customers_affected", "is_escalated")
    full = catalog.with_defaults(bare, model.OUTAGE_INCIDENT)
    return full.withColumn("created_at", F.col("created_at").isNotNull())


# Generators, sized by the test tables.


def _ids(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return lens.table(spark, sf_dir, name).select((F.col(key) + 1).alias("id"))


@query
def gen_outages(spark, sf_dir):
    return generate.outage_records(_ids(spark, sf_dir, "events", "event_id"))


@query
def gen_logs(spark, sf_dir):
    return generate.incident_logs(gen_outages(spark, sf_dir))


@query
def gen_towers(spark, sf_dir):
    towers = generate.towers(_ids(spark, sf_dir, "supplier", "s_suppkey"))
    coordinates = {c: F.col(c).cast("double") for c in ("latitude", "longitude")}
    return towers.withColumns(coordinates)


@query
def gen_engineers(spark, sf_dir):
    return generate.engineers(_ids(spark, sf_dir, "customer", "c_custkey"))


@query
def gen_incidents(spark, sf_dir):
    return generate.incidents(
        _ids(spark, sf_dir, "orders", "o_orderkey"), lens.row_count(spark, sf_dir, "supplier")
    )


@query
def gen_assignments(spark, sf_dir):
    return generate.assignments(
        _ids(spark, sf_dir, "orders", "o_orderkey"), lens.row_count(spark, sf_dir, "customer")
    )


@query
def gen_resolutions(spark, sf_dir):
    return generate.resolutions(
        _ids(spark, sf_dir, "orders", "o_orderkey"), lens.row_count(spark, sf_dir, "customer")
    )


@query
def gen_links(spark, sf_dir):
    return generate.links(
        _ids(spark, sf_dir, "events", "event_id"),
        lens.row_count(spark, sf_dir, "orders"),
        linked_at="2025-01-01",
    )
