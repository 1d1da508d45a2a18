"""Reports and views over the relational model.

Towers, engineers and incidents all grow with the network, so none of them is
marked for broadcast: Spark broadcasts a side only if its measured size is under
the session's threshold and shuffles otherwise. Wherever a report only needs sums,
rows are summed per join key first; a hot tower or engineer then costs one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewarden import model
from linewarden.functions.numbers import count_if, mean_from_sums, percent
from linewarden.operators.joins import join_lookup


def incidents_by_province(incidents: DataFrame, towers: DataFrame) -> DataFrame:
    """Incidents, mean duration and customers hit per province of the tower."""
    per_tower = incidents.groupBy("tower_id").agg(
        F.count("*").alias("incidents"),
        F.sum("duration_min").alias("minutes"),
        F.count("duration_min").alias("timed"),
        F.sum("customers_affected").alias("customers"),
    )
    return (
        per_tower.join(towers.select("tower_id", "province_code"), "tower_id")
        .groupBy("province_code")
        .agg(
            F.sum("incidents").alias("incidents"),
            mean_from_sums(F.sum("minutes"), F.sum("timed"), 1).alias("avg_duration_min"),
            F.sum("customers").alias("customers_hit"),
        )
        .orderBy(F.desc("incidents"), F.asc("province_code"))
    )


def _per_engineer(assignments: DataFrame, incidents: DataFrame) -> DataFrame:
    return (
        assignments.join(incidents, "incident_id")
        .groupBy("engineer_id")
        .agg(
            F.count("*").alias("total_incidents"),
            count_if(F.col("role") == "LEAD").alias("led_incidents"),
            F.sum("customers_affected").alias("total_customers_handled"),
            F.round(F.avg("duration_min"), 1).alias("avg_resolution_min"),
        )
    )


def engineer_workload(
    engineers: DataFrame, assignments: DataFrame, incidents: DataFrame
) -> DataFrame:
    """One row per assigned engineer; the mean covers resolved incidents only."""
    return engineers.join(_per_engineer(assignments, incidents), "engineer_id").select(
        "employee_no",
        "full_name",
        "specialisation",
        "total_incidents",
        "led_incidents",
        "total_customers_handled",
        "avg_resolution_min",
    )


def engineer_workload_top10(
    engineers: DataFrame, assignments: DataFrame, incidents: DataFrame
) -> DataFrame:
    """The ten engineers with most incidents; equal counts are ordered by engineer id."""
    return (
        engineers.join(_per_engineer(assignments, incidents), "engineer_id")
        .orderBy(F.desc("total_incidents"), F.asc("engineer_id"))
        .limit(10)
        .select(
            "full_name",
            "specialisation",
            F.col("total_incidents").alias("incidents"),
            F.col("total_customers_handled").alias("customers_handled"),
        )
    )


def _sla_counts(incidents: DataFrame) -> DataFrame:
    graded = join_lookup(
        incidents,
        "severity_level",
        "severity_id",
        {"label": "label", "sla_resolve_min": "sla_resolve_min"},
    )
    within = F.col("duration_min") <= F.col("sla_resolve_min")
    return (
        graded.groupBy("severity_id", "label", "sla_resolve_min")
        .agg(F.count("*").alias("total"), count_if(within).alias("within_sla"))
        .select(
            "*", percent(F.col("within_sla"), F.col("total")).alias("sla_pct")
        )
        .orderBy("severity_id")
        .drop("severity_id")
    )


def sla_compliance_all(incidents: DataFrame) -> DataFrame:
    """Incidents resolved within their target, per severity; unresolved ones count as late."""
    return _sla_counts(incidents)


def sla_compliance_resolved(incidents: DataFrame) -> DataFrame:
    """As ``sla_compliance_all`` but over resolved incidents only."""
    return _sla_counts(incidents.filter(F.col("resolved_at").isNotNull())).withColumnsRenamed(
        {"label": "severity", "total": "total_incidents"}
    )


def incident_summary(incidents: DataFrame, towers: DataFrame) -> DataFrame:
    """Incidents with tower, carrier, cause and severity spelled out."""
    sites = join_lookup(towers, "carrier", "carrier_id", {"carrier_name": "carrier_name"}).select(
        "tower_id", "tower_code", "city", "province_code", "carrier_name"
    )
    joined = incidents.join(sites, "tower_id")
    joined = join_lookup(joined, "outage_type", "outage_type_id", {"type_code": "outage_type"})
    joined = join_lookup(joined, "severity_level", "severity_id", {"label": "severity"})
    notes = ["root_cause_notes"] if "root_cause_notes" in incidents.columns else []
    return joined.select(
        "incident_ref",
        "tower_code",
        "city",
        "province_code",
        "carrier_name",
        "outage_type",
        "severity",
        "reported_at",
        "resolved_at",
        "duration_min",
        "customers_affected",
        "is_escalated",
        *notes,
    )


def linked_incidents(links: DataFrame, incidents: DataFrame, towers: DataFrame) -> DataFrame:
    """Outages of the extract with the figures of the incident they are linked to."""
    joined = (
        links.select("outage_id", "incident_id")
        .join(incidents, "incident_id")
        .join(towers.select("tower_id", "tower_code", "city"), "tower_id")
    )
    return join_lookup(
        joined, "outage_type", "outage_type_id", {"type_code": "outage_type"}
    ).select(
        "outage_id",
        "incident_ref",
        "tower_code",
        "city",
        "outage_type",
        "duration_min",
        "customers_affected",
    )


def extract_link_join(links: DataFrame, incidents: DataFrame, towers: DataFrame) -> DataFrame:
    """The first ten linked incidents by outage id.

    The ten are found on keys alone; only they are joined to the wide rows.
    """
    types = model.lookup(links.sparkSession, "outage_type").select("outage_type_id")
    first = (
        links.select("outage_id", "incident_id")
        .join(incidents.select("incident_id", "tower_id", "outage_type_id"), "incident_id")
        .join(towers.select("tower_id"), "tower_id", "left_semi")
        .join(F.broadcast(types), "outage_type_id", "left_semi")
        .select("outage_id", "incident_id")
        .orderBy("outage_id")
        .limit(10)
    )
    return linked_incidents(first, incidents, towers).orderBy("outage_id")


def escalated_incidents(incidents: DataFrame) -> DataFrame:
    """Escalated incidents only."""
    return incidents.filter(F.col("is_escalated"))


def network_reports(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four reports by name over the model's tables; each is lazy until used."""
    incidents, towers = tables["outage_incident"], tables["tower"]
    engineers, assignments = tables["engineer"], tables["incident_assignment"]
    return {
        "incidents_by_province": incidents_by_province(incidents, towers),
        "engineer_workload": engineer_workload_top10(engineers, assignments, incidents),
        "sla_compliance": sla_compliance_all(incidents),
        "extract_link_join": extract_link_join(tables["extract_link"], incidents, towers),
    }


def network_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The model's views by name."""
    incidents, towers = tables["outage_incident"], tables["tower"]
    return {
        "v_incident_summary": incident_summary(incidents, towers),
        "v_engineer_workload": engineer_workload(
            tables["engineer"], tables["incident_assignment"], incidents
        ),
        "v_sla_compliance": sla_compliance_resolved(incidents),
        "v_escalated_incidents": escalated_incidents(incidents),
    }
