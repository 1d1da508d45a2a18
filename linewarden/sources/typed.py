"""Texts typed by column, with a side table of the records that hold a value that does not fit.

A first pass counts, for every column at once, what its texts can be read as. It settles one
date format for a date column, and whether a column of whole numbers holds fractions and so
is one of doubles. The second pass types all records in that way: no record is lost, a value
that does not fit is null in its place and kept as text among the rejects.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden import model
from linewarden.functions.times import best_format, format_counts, read_as
from linewarden.session import materialize
from linewarden.sources.readers import MISSING_MARKERS

CORRUPT = "_corrupt_record"


class ColumnProfile(NamedTuple):
    """How a column is read, and what was counted: texts that are there and that do not fit."""

    type: T.DataType
    date_format: str | None
    present: int
    rejected: int


class Typed(NamedTuple):
    """All records, typed; those with a value that does not fit, as texts; the columns."""

    rows: DataFrame
    rejects: DataFrame
    columns: dict[str, ColumnProfile]


def _present(name: str) -> Column:
    value = F.col(f"`{name}`").cast("string")
    return F.when(~value.isin(*MISSING_MARKERS), value)


def _whole(value: Column, wanted: T.DataType) -> Column:
    """A whole number, also where it is written as a decimal such as ``90.0`` or ``1e3``."""
    exact = value.try_cast("decimal(38,9)")
    return F.coalesce(
        value.try_cast(wanted), F.when(exact == F.floor(exact), exact.try_cast(wanted))
    )


def _number(value: Column) -> Column:
    """A finite number; texts such as ``Infinity`` are none."""
    number = value.try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def _typed(value: Column, profile: ColumnProfile) -> Column:
    if isinstance(profile.type, T.StringType):
        return value
    if profile.date_format:
        return read_as(value, profile.date_format)
    if isinstance(profile.type, T.IntegralType):
        return _whole(value, profile.type)
    if isinstance(profile.type, T.FractionalType) and not isinstance(profile.type, T.DecimalType):
        return _number(value).cast(profile.type)
    return value.try_cast(profile.type)


def _counts(value: Column, wanted: T.DataType) -> list[Column]:
    if isinstance(wanted, T.TimestampNTZType):
        return format_counts(value)
    if isinstance(wanted, T.IntegralType):
        whole, number = _whole(value, wanted), _number(value)
        fraction = whole.isNull() & (number % 1 != 0)
        return [
            F.count(value),
            F.count(whole),
            F.count(number),
            F.count(F.when(fraction, number)),
        ]
    return [F.count(value), F.count(_typed(value, ColumnProfile(wanted, None, 0, 0)))]


def _profile(wanted: T.DataType, counts: list[int]) -> ColumnProfile:
    if isinstance(wanted, T.TimestampNTZType):
        name, unread = best_format(counts)
        return ColumnProfile(wanted, name, counts[0], unread)
    if isinstance(wanted, T.IntegralType):
        present, whole, number, fractions = counts
        if fractions:
            return ColumnProfile(T.DoubleType(), None, present, present - number)
        return ColumnProfile(wanted, None, present, present - whole)
    return ColumnProfile(wanted, None, counts[0], counts[0] - counts[1])


def type_columns(text: DataFrame, schema: T.StructType = model.OUTAGE_RECORDS) -> Typed:
    """The texts of a DataFrame typed as the columns of ``schema`` that it has.

    Other columns stay text. A missing marker is null and not rejected. A fraction in a column
    of whole numbers makes it one of doubles, so the fraction is kept; a number too large for
    a whole one is then a double as well. Infinity and NaN are not numbers of a record. A date
    column is read in the format that reads most of it. A column ``_corrupt_record`` holds
    records that could not be split into fields: they are rejects only, as a whole.

    ``rejects`` has the columns as text and ``rejected``, an array of column, value and type.
    An empty table has no rejects.
    """
    names = [c for c in text.columns if c != CORRUPT]
    wanted = {f.name: f.dataType for f in schema.fields}
    types = {name: wanted.get(name, T.StringType()) for name in names}
    split = text.filter(F.col(CORRUPT).isNull()) if CORRUPT in text.columns else text
    checked = [n for n in names if not isinstance(types[n], T.StringType)]
    totals = {n: _counts(_present(n), types[n]) for n in checked}
    row = split.agg(F.count("*"), *[c for n in checked for c in totals[n]]).first()
    at, columns = 1, {}
    for name in names:
        if name in totals:
            counts = list(row[at : at + len(totals[name])])
            at += len(totals[name])
            columns[name] = _profile(types[name], counts)
        else:
            columns[name] = ColumnProfile(T.StringType(), None, 0, 0)

    rows = split.select(*[_typed(_present(n), columns[n]).alias(n) for n in names])
    faults = [
        F.when(
            _present(n).isNotNull() & _typed(_present(n), columns[n]).isNull(),
            _fault(F.lit(n), _present(n), F.lit(columns[n].type.simpleString())),
        )
        for n in checked
    ]
    if CORRUPT in text.columns:
        whole = _fault(F.lit(None).cast("string"), F.col(CORRUPT), F.lit("record"))
        faults.append(F.when(F.col(CORRUPT).isNotNull(), whole))
        faults[:-1] = [F.when(F.col(CORRUPT).isNull(), fault) for fault in faults[:-1]]
    kept = [F.col(f"`{n}`").cast("string").alias(n) for n in names]
    none = F.array().cast("array<struct<column:string,value:string,type:string>>")
    rejected = F.array_compact(F.array(*faults)) if faults else none
    rejects = text.select(*kept, rejected.alias("rejected")).filter(F.size("rejected") > 0)
    return Typed(rows, rejects, columns)


def _fault(column: Column, value: Column, wanted: Column) -> Column:
    return F.struct(column.alias("column"), value.alias("value"), wanted.alias("type"))


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType = model.OUTAGE_RECORDS,
    multiline: bool = False,
) -> Typed:
    """CSV with a header row, typed by column; every record is a row or, as a whole, a reject.

    As ``type_columns`` says. Records with too few or too many fields are rejects. A further
    file with another header is an error. The files are parsed once, each to its end: the texts
    are written down by column, and the passes that count and type read those.
    """
    options = {"header": True, "escape": '"', "multiLine": multiline, "enforceSchema": False}
    names = spark.read.csv(path, **options).columns
    fields = ", ".join(f"`{n}` string" for n in [*names, CORRUPT])
    text = (
        spark.read.schema(fields)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .csv(path, **options)
    )
    return type_columns(materialize(text, "csv_texts"), schema)
