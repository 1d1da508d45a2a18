"""Writing the extract and the model's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Replace a parquet folder and return what was written."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace a catalog table and return it; ``path`` keeps its files outside the warehouse."""
    writer = df.write.format("parquet").mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def persist_extract(
    extract: DataFrame, logs: DataFrame, path: str, database: str | None = None
) -> dict[str, DataFrame]:
    """Write the extract as parquet and as table ``outage_events``, the raw logs as
    ``incident_logs``.

    The extract is computed and written once: the table's files are the parquet folder.
    Each write is atomic for its own folder or table; there is no transaction across them.
    """
    prefix = f"{database}." if database else ""
    table = replace_table(extract, f"{prefix}outage_events", path)
    return {
        "extract": extract.sparkSession.read.parquet(path),
        "outage_events": table,
        "incident_logs": replace_table(logs, f"{prefix}incident_logs"),
    }


def write_incidents(incidents: DataFrame, path: str) -> DataFrame:
    """Write incidents for lookups by time: one folder per month, files sorted by report time.

    The rebalance hint evens out file sizes, so a busy month becomes several files and a
    quiet one a single file. Readers skip months by folder and row groups by time range.
    """
    year, month = F.year("reported_at"), F.month("reported_at")
    (
        incidents.withColumns({"reported_year": year, "reported_month": month})
        .hint("rebalance", F.col("reported_year"), F.col("reported_month"))
        .sortWithinPartitions("reported_year", "reported_month", "reported_at")
        .write.mode("overwrite")
        .partitionBy("reported_year", "reported_month")
        .parquet(path)
    )
    return incidents.sparkSession.read.parquet(path)
