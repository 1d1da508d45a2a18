"""Reports over the extract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewarden.functions.numbers import percent, weighted_mean, weighted_sum

# The columns of the raw records that the reports need.
INPUT_COLUMNS = (
    "outage_id",
    "province",
    "outage_type",
    "onset_dt",
    "duration_min",
    "customers_affected",
    "carrier",
)

TOP10_COLUMNS = (
    "outage_id",
    "province",
    "carrier",
    "outage_type",
    "duration_min",
    "customers_affected",
    "engineer_name",
)


def weighed(extract: DataFrame) -> DataFrame:
    """The extract with a weight of one per row, as the reports below take it.

    They take ``operators.extract.weighed_outages`` as well, which has one row per outage.
    """
    if "weight" in extract.columns:
        return extract
    return extract.withColumns(
        {"weight": F.lit(1), "escalations": F.col("is_escalation").cast("int")}
    )


def outages_by_province(extract: DataFrame) -> DataFrame:
    """Outages, mean duration and customers hit per province, most outages first."""
    return (
        weighed(extract)
        .groupBy("province")
        .agg(
            F.sum("weight").alias("total_outages"),
            F.round(weighted_mean("duration_min"), 1).alias("avg_duration_min"),
            weighted_sum("customers_affected").alias("total_customers_hit"),
        )
        .orderBy(F.desc("total_outages"), F.asc("province"))
    )


def worst_outage_types(extract: DataFrame) -> DataFrame:
    """Outages, mean duration and mean customers per cause, longest mean first."""
    return (
        weighed(extract)
        .groupBy("outage_type")
        .agg(
            F.sum("weight").alias("incidents"),
            F.round(weighted_mean("duration_min"), 1).alias("avg_duration_min"),
            F.round(weighted_mean("customers_affected"), 0).alias("avg_customers"),
        )
        .orderBy(F.desc_nulls_last("avg_duration_min"), F.asc("outage_type"))
    )


def escalation_rate_by_carrier(extract: DataFrame) -> DataFrame:
    """Share of outages per carrier whose log speaks of an escalation, highest first.

    Outages without a log count in the total.
    """
    return (
        weighed(extract)
        .groupBy("carrier")
        .agg(F.sum("weight").alias("total"), F.sum("escalations").alias("escalations"))
        .select(
            "carrier",
            "total",
            "escalations",
            percent(F.col("escalations"), F.col("total")).alias("escalation_pct"),
        )
        .orderBy(F.desc_nulls_last("escalation_pct"), F.asc("carrier"))
    )


def monthly_trend(extract: DataFrame) -> DataFrame:
    """Outages and customers per month; records without a date form one null group."""
    return (
        weighed(extract)
        .groupBy("year", "month")
        .agg(
            F.sum("weight").alias("outages"),
            weighted_sum("customers_affected").alias("customers_affected"),
        )
        .orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month"))
    )


def top10_longest_outages(extract: DataFrame) -> DataFrame:
    """The ten longest outages; equal durations are ordered by id."""
    return (
        extract.select(*TOP10_COLUMNS)
        .orderBy(F.desc_nulls_last("duration_min"), F.asc("outage_id"), F.asc("engineer_name"))
        .limit(10)
    )


OUTAGE_REPORTS = {
    "outages_by_province": outages_by_province,
    "worst_outage_types": worst_outage_types,
    "escalation_rate_by_carrier": escalation_rate_by_carrier,
    "monthly_trend": monthly_trend,
    "top10_longest_outages": top10_longest_outages,
}


def run_outage_reports(extract: DataFrame) -> dict[str, DataFrame]:
    """Every report by name; each is lazy until used."""
    return {name: report(extract) for name, report in OUTAGE_REPORTS.items()}


def report_groups(extract: DataFrame) -> DataFrame:
    """What the four grouped reports and the key metrics need, from one pass.

    One row per province, cause, carrier and month; ``grouped`` names the grouping. There are
    only as many rows as groups, so write them down and derive the reports from them.
    """
    names = ["province", "outage_type", "carrier", "year", "month"]
    sets = [["province"], ["outage_type"], ["carrier"], ["year", "month"]]
    grouped = F.lit("month")
    for name in names[2::-1]:
        grouped = F.when(F.grouping(name) == 0, F.lit(name)).otherwise(grouped)
    return weighed(extract).groupingSets(sets, *names).agg(
        grouped.alias("grouped"),
        F.sum("weight").alias("outages"),
        F.sum("escalations").alias("escalations"),
        weighted_sum("customers_affected").alias("customers"),
        F.round(weighted_mean("duration_min"), 1).alias("mean_minutes"),
        F.round(weighted_mean("customers_affected"), 0).alias("mean_customers"),
    )


def reports_of_groups(groups: DataFrame) -> dict[str, DataFrame]:
    """The grouped reports, with the rows and order of those over the extract."""

    def of(name: str) -> DataFrame:
        return groups.filter(F.col("grouped") == name)

    return {
        "outages_by_province": of("province")
        .select(
            "province",
            F.col("outages").alias("total_outages"),
            F.col("mean_minutes").alias("avg_duration_min"),
            F.col("customers").alias("total_customers_hit"),
        )
        .orderBy(F.desc("total_outages"), F.asc("province")),
        "worst_outage_types": of("outage_type")
        .select(
            "outage_type",
            F.col("outages").alias("incidents"),
            F.col("mean_minutes").alias("avg_duration_min"),
            F.col("mean_customers").alias("avg_customers"),
        )
        .orderBy(F.desc_nulls_last("avg_duration_min"), F.asc("outage_type")),
        "escalation_rate_by_carrier": of("carrier")
        .select(
            "carrier",
            F.col("outages").alias("total"),
            "escalations",
            percent(F.col("escalations"), F.col("outages")).alias("escalation_pct"),
        )
        .orderBy(F.desc_nulls_last("escalation_pct"), F.asc("carrier")),
        "monthly_trend": of("month")
        .select("year", "month", "outages", F.col("customers").alias("customers_affected"))
        .orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month")),
    }
