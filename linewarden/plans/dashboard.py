"""The figures behind the dashboard, one dataset per panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewarden.functions.numbers import weighted_mean, weighted_sum
from linewarden.functions.times import period_label
from linewarden.plans.outage_reports import weighed


def panel_province(by_province: DataFrame) -> DataFrame:
    """Outages per province, fewest first as a bar chart draws them."""
    return by_province.select("province", "total_outages").orderBy(
        F.asc("total_outages"), F.desc("province")
    )


def panel_type_duration(by_type: DataFrame) -> DataFrame:
    """Mean duration per cause; every cause that reaches the highest mean is flagged."""
    highest = by_type.agg(F.max("avg_duration_min")).scalar()
    return by_type.select(
        "outage_type",
        "avg_duration_min",
        F.coalesce(F.col("avg_duration_min") == highest, F.lit(False)).alias("is_max"),
    ).orderBy(F.asc_nulls_first("avg_duration_min"), F.desc("outage_type"))


def panel_escalation(by_carrier: DataFrame) -> DataFrame:
    """Escalation rate per carrier, lowest first."""
    return by_carrier.select("carrier", "escalation_pct").orderBy(
        F.asc_nulls_first("escalation_pct"), F.desc("carrier")
    )


def panel_trend(by_month: DataFrame) -> DataFrame:
    """Outages per ``YYYY-MM``; outages without a date come last under a null label."""
    return by_month.select(
        period_label(F.col("year"), F.col("month")).alias("period"), "outages"
    ).orderBy(F.asc_nulls_last("period"))


def key_metrics(extract: DataFrame) -> DataFrame:
    """One row: outages, customers, mean over the causes' means, province with most outages.

    Both groupings are taken in one pass over the extract.
    """
    sets = [["province"], ["outage_type"]]
    groups = weighed(extract).groupingSets(sets, "province", "outage_type").agg(
        (F.grouping("province") == 0).alias("per_province"),
        F.sum("weight").alias("outages"),
        weighted_sum("customers_affected").alias("customers"),
        F.round(weighted_mean("duration_min"), 1).alias("mean_minutes"),
    )
    per_province = F.col("per_province")
    rank = F.when(per_province, F.struct(-F.col("outages"), F.col("province")))
    return groups.agg(
        F.sum(F.when(per_province, F.col("outages"))).alias("total_outages"),
        F.sum(F.when(per_province, F.col("customers"))).alias("total_customers"),
        F.avg(F.when(~per_province, F.col("mean_minutes"))).alias("avg_duration_min"),
        F.min_by("province", rank).alias("worst_province"),
    )


def key_metrics_of_groups(groups: DataFrame) -> DataFrame:
    """The key metrics from the groups of ``outage_reports.report_groups``."""
    is_province = F.col("grouped") == "province"
    rank = F.when(is_province, F.struct(-F.col("outages"), F.col("province")))
    return groups.agg(
        F.sum(F.when(is_province, F.col("outages"))).alias("total_outages"),
        F.sum(F.when(is_province, F.col("customers"))).alias("total_customers"),
        F.avg(F.when(F.col("grouped") == "outage_type", F.col("mean_minutes"))).alias(
            "avg_duration_min"
        ),
        F.min_by("province", rank).alias("worst_province"),
    )


def metric_cards(metrics: DataFrame) -> DataFrame:
    """The key metrics as four label and text rows."""
    cards = [
        ("Total outages", F.format_number("total_outages", 0)),
        ("Customers affected", F.format_number("total_customers", 0)),
        (
            "Avg duration",
            F.concat(F.bround("avg_duration_min").cast("bigint").cast("string"), F.lit(" min")),
        ),
        ("Most affected province", F.col("worst_province")),
    ]
    return metrics.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(name).alias("label"), text.alias("value")) for name, text in cards]
            )
        )
    )
