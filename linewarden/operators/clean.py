"""Cleaning of raw outage records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewarden.functions import numbers, text, times

# The keys a record must have, and the longest believable outage (10 days).
KEYS = ("outage_id", "province")
MAX_DURATION_MIN = 14_400


def has_keys() -> Column:
    """True for a record the cleaning keeps."""
    return F.col(KEYS[0]).isNotNull() & F.col(KEYS[1]).isNotNull()


def _as_timestamp(value: Column) -> Column:
    return value.try_cast("timestamp_ntz")


def clean_outages(raw: DataFrame, onset_format: str | None = None) -> DataFrame:
    """Drop records without keys, normalise provinces, cap durations and add calendar fields.

    Columns other than the keys are optional: a step whose column is absent is left out.
    Dates that are still texts are read in ``onset_format``, that of their column
    (``times.column_format``), or without it each in the first format that fits.
    """
    absent = [key for key in KEYS if key not in raw.columns]
    if absent:
        raise ValueError(f"outage records lack the key columns {absent}")

    dates = dict(raw.dtypes).get("onset_dt")
    def dated(value: Column) -> Column:
        if dates != "string":
            return _as_timestamp(value)
        if onset_format:
            return times.read_as(value, onset_format)
        return times.parse_timestamp(value)

    cleaners = {
        "province": text.upper_strip,
        "onset_dt": dated,
        "duration_min": lambda minutes: numbers.clip_upper(minutes, MAX_DURATION_MIN),
    }
    kept = raw.filter(has_keys()).select(
        *[
            cleaners[name](F.col(name)).alias(name) if name in cleaners else F.col(name)
            for name in raw.columns
        ]
    )
    if "onset_dt" not in raw.columns:
        return kept
    onset = F.col("onset_dt")
    return kept.select(
        "*",
        F.year(onset).alias("year"),
        F.month(onset).alias("month"),
        times.weekday_name(onset).alias("weekday"),
    )
