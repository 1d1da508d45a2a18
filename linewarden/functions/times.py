"""Expressions over timestamps. All timestamps are ``timestamp_ntz`` wall-clock UTC."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO = "ISO"


# The date formats read besides ISO ones, in the order they are tried. Where
# a text fits several, day before month loses to month before day.
DATE_FORMATS = (
    "yyyy/M/d[ H:mm[:ss]]",
    "M/d/yyyy[ H:mm[:ss]]",
    "d/M/yyyy[ H:mm[:ss]]",
    "d-M-yyyy[ H:mm[:ss]]",
    "d.M.yyyy[ H:mm[:ss]]",
    "d-MMM-yyyy[ H:mm[:ss]]",
    "d MMM yyyy[ H:mm[:ss]]",
    "MMM d, yyyy[ H:mm[:ss]]",
    "yyyyMMdd[HHmmss]",
)
_OFFSET = r"\d{2}:\d{2}.*(?:Z|[+-]\d{2}(?::?\d{2})?)$"


def parse_timestamp(text: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """Timestamp of a text, null when no format reads it.

    ISO-like texts come first, then ``formats`` in their order; the first that fits wins.
    A text with an offset is converted to UTC, one without is taken as it stands.
    """
    others = [read_as(text, f) for f in formats]
    return F.when(_has_offset(text), read_as(text, ISO)).otherwise(
        F.coalesce(read_as(text, ISO), *others)
    )


def _has_offset(text: Column) -> Column:
    return F.btrim(text.cast("string")).rlike(_OFFSET)


def read_as(text: Column, date_format: str) -> Column:
    """Timestamp of a text in one format, null when it does not fit; ``ISO`` for ISO-like
    ones."""
    text = F.btrim(text.cast("string"))
    if date_format != ISO:
        return F.try_to_timestamp(text, F.lit(date_format)).cast("timestamp_ntz")
    utc = F.to_utc_timestamp(text.try_cast("timestamp"), F.current_timezone())
    return F.when(text.rlike(_OFFSET), utc.cast("timestamp_ntz")).otherwise(
        text.try_cast("timestamp_ntz")
    )


class ColumnFormat(NamedTuple):
    """The one format a column is read in, and how many of its texts that leaves unread."""

    name: str
    unread: int


def format_counts(text: Column, formats: tuple[str, ...] = (ISO, *DATE_FORMATS)) -> list[Column]:
    """Aggregates: how many texts there are, and how many each format reads."""
    return [F.count(text), *[F.count(read_as(text, f)) for f in formats]]


def best_format(
    counts: list[int], formats: tuple[str, ...] = (ISO, *DATE_FORMATS)
) -> ColumnFormat:
    """The format that reads most of a column, of equals the earliest."""
    texts, *read = counts
    at = max(range(len(formats)), key=lambda i: (read[i], -i))
    return ColumnFormat(formats[at], texts - read[at])


def column_format(df: DataFrame, column: str) -> ColumnFormat:
    """The format of a text column, found by counting in one pass over it.

    All of a column is read in one format: 03/02 beside 13/02 is the third of February. Where
    all texts fit several formats, month before day wins.
    """
    return best_format(list(df.agg(*format_counts(F.col(f"`{column}`"))).first()))


def weekday_name(ts: Column) -> Column:
    """English day name in full. Goes through the date so no session zone can shift it."""
    return F.date_format(ts.cast("date"), "EEEE")


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, halves rounded away from zero; null if either is.

    Takes the parts of the interval: ``timestampdiff`` would go through the session zone.
    """
    elapsed = end - start
    seconds = (
        F.date_part(F.lit("DAY"), elapsed) * F.lit(86400)
        + F.date_part(F.lit("HOUR"), elapsed) * F.lit(3600)
        + F.date_part(F.lit("MINUTE"), elapsed) * F.lit(60)
        + F.date_part(F.lit("SECOND"), elapsed).cast("double")
    )
    return F.round(seconds / F.lit(60.0)).cast("int")


def plus_minutes(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, ts)


def timestamp_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a timestamp, fractions cut off."""
    return F.substring(ts.cast("string"), 1, 19)


def clock_text(ts: Column) -> Column:
    """``HH:mm:ss`` text of a timestamp."""
    return F.substring(ts.cast("string"), 12, 8)


def period_label(year: Column, month: Column) -> Column:
    """``YYYY-MM``, null when either part is null."""
    return F.concat(
        year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0")
    )
