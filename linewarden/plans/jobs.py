"""End-to-end jobs: the outage extract, and the seeded network model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewarden import model
from linewarden.functions.times import column_format
from linewarden.operators import generate, linking
from linewarden.operators.clean import clean_outages
from linewarden.operators.extract import build_extract
from linewarden.operators.logs import parse_logs
from linewarden.operators.metrics import Counted, log_counts, raw_counts, row_counts
from linewarden.plans import dashboard
from linewarden.plans.network_reports import network_reports, network_views
from linewarden.plans.outage_reports import (
    report_groups,
    reports_of_groups,
    top10_longest_outages,
)
from linewarden.session import materialize
from linewarden.sources.catalog import create_database, create_tables, register_views
from linewarden.sources.inserts import append_or_ignore
from linewarden.sources.publish import publish
from linewarden.sources.writers import replace_table


@dataclass(frozen=True)
class ExtractRun:
    """What an extract run leaves behind; all DataFrames read the written extract."""

    tables: dict[str, DataFrame]
    reports: dict[str, DataFrame]
    panels: dict[str, DataFrame]
    metrics: DataFrame
    report_rows: DataFrame


def run_extract(
    raw: DataFrame,
    logs: DataFrame,
    path: str,
    database: str | None = None,
    publish_to: str | None = None,
) -> ExtractRun:
    """Clean, parse, join and write once; reports and panels read what was written.

    Raw records and logs are read once each, by the passes that write them down (the logs as
    table ``incident_logs``); these passes take the counts as well. Dates that are texts are
    all read in the one format that fits most of them; ``dates_unread`` counts the others. The
    grouped reports and the key metrics come from one pass over the written extract.
    ``publish_to`` names a folder where extract and logs are published together
    (``sources.publish``).
    """
    spark, counted = raw.sparkSession, Counted()
    prefix = f"{database}." if database else ""
    records = materialize(counted.on(raw, "outages", raw_counts()), "records")
    onset_format = None
    if dict(records.dtypes).get("onset_dt") == "string":
        onset_format, unread = column_format(records, "onset_dt")
        counted.add("outages", dates_unread=unread)
    cleaned = clean_outages(records, onset_format)
    texts = counted.on(logs, "logs", log_counts())
    stored_logs = replace_table(texts, f"{prefix}incident_logs")
    extract = build_extract(cleaned, parse_logs(stored_logs))
    rows = {"rows": F.count("*")}
    whole = counted.on(extract, "extract", rows, columns=len(extract.columns))
    events = replace_table(whole, f"{prefix}outage_events", path)
    written = spark.read.parquet(path)
    tables = {"extract": written, "outage_events": events, "incident_logs": stored_logs}
    if publish_to:
        pair = {"outage_events": written, "incident_logs": stored_logs}
        tables |= {f"published_{n}": df for n, df in publish(spark, publish_to, pair).items()}

    groups = materialize(report_groups(written), "report_groups")
    reports = reports_of_groups(groups)
    reports["top10_longest_outages"] = top10_longest_outages(written)
    panels = {
        "panel_province": dashboard.panel_province(reports["outages_by_province"]),
        "panel_type_duration": dashboard.panel_type_duration(reports["worst_outage_types"]),
        "panel_escalation": dashboard.panel_escalation(reports["escalation_rate_by_carrier"]),
        "panel_trend": dashboard.panel_trend(reports["monthly_trend"]),
        "key_metrics": dashboard.key_metrics_of_groups(groups),
    }
    return ExtractRun(tables, reports, panels, counted.rows(spark), row_counts(reports))


@dataclass(frozen=True)
class NetworkSizes:
    """How many rows each generator makes."""

    towers: int = 60
    engineers: int = 30
    incidents: int = 120
    outages: int = 300


@dataclass(frozen=True)
class NetworkRun:
    tables: dict[str, DataFrame]
    views: dict[str, DataFrame]
    reports: dict[str, DataFrame]
    rows_offered: DataFrame
    rows_added: dict[str, int]


# The tables whose rows others refer to, besides the lookups.
PARENTS = ("tower", "engineer", "outage_incident")


def network_rows(
    spark: SparkSession,
    sizes: NetworkSizes,
    seed: int = 7,
    parents: dict[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Rows for every table of the model, parents before children.

    ``parents`` gives the row counts of parent tables, where they are not those of ``sizes``.
    References are places among the parents, counted from 1.
    """
    counts = dict(zip(PARENTS, (sizes.towers, sizes.engineers, sizes.incidents)))
    counts |= parents or {}
    incident_ids = generate.ids(spark, counts["outage_incident"])
    rows = {name: model.lookup(spark, name) for name in model.LOOKUPS}
    rows["tower"] = generate.towers(generate.ids(spark, sizes.towers), seed)
    rows["engineer"] = generate.engineers(generate.ids(spark, sizes.engineers), seed)
    rows["outage_incident"] = generate.incidents(
        generate.ids(spark, sizes.incidents), counts["tower"], seed
    )
    rows["incident_assignment"] = generate.assignments(incident_ids, counts["engineer"], seed)
    rows["resolution_log"] = generate.resolutions(incident_ids, counts["engineer"], seed)
    rows["extract_link"] = generate.links(
        generate.ids(spark, sizes.outages), counts["outage_incident"]
    )
    return rows


def seed_network(
    spark: SparkSession,
    database: str,
    location: str | None = None,
    sizes: NetworkSizes = NetworkSizes(),
    replace: bool = False,
) -> NetworkRun:
    """Create the model's tables, insert what is not there yet and register the views.

    Children refer to the rows that are stored, also to those of earlier runs or other
    sources, whatever gaps their ids have.
    """
    create_database(spark, database, location, replace)
    create_tables(spark, database)
    added, offered = {}, {}
    stored: dict[str, DataFrame] = {}
    counts: dict[str, int] = {}
    sparse: dict[str, linking.Keys] = {}
    offers = network_rows(spark, sizes)
    usual = dict(zip(PARENTS, (sizes.towers, sizes.engineers, sizes.incidents)))
    for name in list(offers):
        table = model.TABLES[name]
        target = f"{database}.{name}"
        rows = offers[name]
        for column, (parent, _) in table.references.items():
            if parent in sparse:
                rows = linking.key_at(rows, F.col(column), sparse[parent], column)
        offered[name] = rows
        added[name] = append_or_ignore(spark, table, target, rows, [table.primary_key], stored)
        stored[name] = spark.table(target)
        if name in PARENTS:
            counts[name] = stored[name].count()
            if counts[name] != usual[name]:
                offers = network_rows(spark, sizes, parents=counts)
            if not linking.are_dense(stored[name], table.primary_key):
                sparse[name] = linking.keys_of(stored[name], table.primary_key)
    views = network_views(stored)
    register_views(views)
    return NetworkRun(stored, views, network_reports(stored), row_counts(offered), added)
