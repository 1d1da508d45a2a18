"""Free-text incident logs to structured fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewarden.functions import text


def parse_logs(logs: DataFrame) -> DataFrame:
    """Add engineer name, minutes and escalation flag to ``(outage_id, log_text)`` rows."""
    log_text = F.col("log_text")
    matches = text.engineer_matches(log_text)
    names = [f"_engineer_match_{i}" for i in range(len(matches))]
    matched = logs.select("*", *[m.alias(name) for m, name in zip(matches, names)])
    return matched.select(
        *[F.col(f"`{c}`") for c in logs.columns],
        text.engineer_name(log_text, [F.col(name) for name in names]).alias("engineer_name"),
        text.duration_minutes(log_text).alias("log_duration_min"),
        text.mentions_escalation(log_text).alias("is_escalation"),
    )
