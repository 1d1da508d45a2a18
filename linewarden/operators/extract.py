"""The wide extract: cleaned outages with their parsed logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewarden.operators.joins import left_join
from linewarden.session import materialize

LOG_FIELDS = ("log_text", "engineer_name", "log_duration_min", "is_escalation")


def build_extract(outages: DataFrame, parsed_logs: DataFrame) -> DataFrame:
    """Left join of outages and parsed logs; an outage without a log keeps null log fields."""
    logs = parsed_logs.select("outage_id", *LOG_FIELDS)
    return left_join(outages, logs, "outage_id").select(*outages.columns, *LOG_FIELDS)


def weighed_outages(outages: DataFrame, parsed_logs: DataFrame) -> DataFrame:
    """One row per outage for the reports that need no log text, in place of the extract.

    ``weight`` is how many rows the outage has in the extract, ``escalations`` how many of
    its logs speak of one (null without a log). The logs are counted per outage before the
    join, so an outage with most of the logs is one row of it.
    """
    counted = parsed_logs.groupBy("outage_id").agg(
        F.count("*").alias("weight"), F.sum(F.col("is_escalation").cast("int")).alias("escalations")
    )
    joined = outages.join(counted, "outage_id", "left")
    return joined.withColumn("weight", F.coalesce("weight", F.lit(1)))


def longest_outages(outages: DataFrame, parsed_logs: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` extract rows by duration, without building the extract.

    The order rests on outage columns only, so the ``k`` longest outages are found
    first and written down, and only their logs take part in the join.
    """
    order = [F.desc_nulls_last("duration_min"), F.asc("outage_id")]
    longest = materialize(outages.orderBy(*order).limit(k), "longest_outages")
    logs = parsed_logs.select("outage_id", *LOG_FIELDS)
    logs = logs.join(longest.select("outage_id"), "outage_id", "left_semi")
    return (
        longest.join(logs, "outage_id", "left")
        .select(*outages.columns, *LOG_FIELDS)
        .orderBy(*order, "engineer_name", *LOG_FIELDS)
        .limit(k)
    )
