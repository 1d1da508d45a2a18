"""Counts a load reports about itself.

Counts of any DataFrame are taken by aggregation. ``Counted`` takes them in the pass that
writes the rows, so nothing is read twice. Spark adds up such counts per task. In the stage
that writes, it takes the first finished run of each task only, so a task that is run again,
after a lost executor or by speculation, is counted once. A shuffle stage that is run again
would count again: put the count behind the last shuffle before the write, or write first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linewarden.functions.numbers import count_if
from linewarden.functions.text import mentions_escalation
from linewarden.operators.clean import has_keys
from linewarden.operators.quality import union_all


def _rows(df: DataFrame, step: str, counted: dict[str, Column]) -> DataFrame:
    """One row per named aggregate."""
    counts = df.agg(
        *[F.coalesce(total, F.lit(0)).cast("bigint").alias(name) for name, total in counted.items()]
    )
    rows = ", ".join(f"'{step}', '{name}', {name}" for name in counted)
    return counts.select(
        F.expr(f"stack({len(counted)}, {rows})").alias("step", "metric", "value")
    )


class Counted:
    """Counts by step and name, taken while the rows of the step are written."""

    def __init__(self) -> None:
        self._steps: dict[str, tuple[Observation, dict[str, int]]] = {}

    def on(self, df: DataFrame, step: str, counted: dict[str, Column], **known: int) -> DataFrame:
        """The same rows; their counts are there once they are written. ``known`` adds numbers
        that need no rows."""
        seen = Observation()
        self._steps[step] = seen, known
        totals = [F.coalesce(total, F.lit(0)).alias(name) for name, total in counted.items()]
        return df.observe(seen, *totals)

    def add(self, step: str, **known: int) -> None:
        """Further numbers of a step."""
        self._steps[step][1].update(known)

    def rows(self, spark: SparkSession) -> DataFrame:
        """All counts as ``step, metric, value`` rows, after the writes."""
        values = [
            (step, name, int(value))
            for step, (seen, known) in self._steps.items()
            for name, value in (seen.get | known).items()
        ]
        return spark.createDataFrame(values, "step string, metric string, value bigint")


def raw_counts() -> dict[str, Column]:
    """Records loaded, and records the cleaning drops for missing keys."""
    return {"rows_loaded": F.count("*"), "rows_dropped": count_if(~has_keys())}


def log_counts() -> dict[str, Column]:
    """Logs read, and logs that speak of an escalation."""
    flagged = count_if(mentions_escalation(F.col("log_text")))
    return {"rows_loaded": F.count("*"), "escalations_flagged": flagged}


def load_metrics(raw: DataFrame) -> DataFrame:
    """Records loaded, and records the cleaning drops for missing keys."""
    return _rows(raw, "outages", raw_counts())


def log_metrics(logs: DataFrame) -> DataFrame:
    """Logs read, and logs that speak of an escalation."""
    return _rows(logs, "logs", log_counts())


def extract_shape(extract: DataFrame) -> DataFrame:
    """Rows and columns of the extract."""
    width = F.max(F.lit(len(extract.columns)))
    return _rows(extract, "extract", {"rows": F.count("*"), "columns": width})


def extract_metrics(raw: DataFrame, logs: DataFrame, extract: DataFrame) -> DataFrame:
    """All counts of an extract run as ``step, metric, value`` rows."""
    return union_all([load_metrics(raw), log_metrics(logs), extract_shape(extract)])


def row_counts(named: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named DataFrame, such as the reports or the seeded tables."""
    return union_all(
        [
            df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("name"), "row_count")
            for name, df in named.items()
        ]
    )
