"""Reading outage records and tables."""

from __future__ import annotations

import logging
from collections.abc import Callable
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden import model
from linewarden.functions.times import parse_timestamp
from linewarden.operators.clean import KEYS

log = logging.getLogger(__name__)

# The texts a CSV field may hold in place of a missing value.
MISSING_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = model.OUTAGE_RECORDS,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header row, typed by column name; a leading byte order mark is skipped.

    Columns may come in any order and the schema's optional ones may be absent.
    Columns outside the schema stay text. A whole number may be written as a decimal
    (``90.0``); a fraction is rounded to the nearest whole number, halves away from zero.
    Dates are read as ``parse_timestamp`` does. A value that does not fit its type is null.

    ``multiline`` allows line breaks inside quoted fields; such a file cannot be split.
    Without it a record that such a break cuts in two is an error, as is any record with
    too few or too many fields: no value ever lands in another column.
    """
    types = {f.name: f.dataType for f in schema.fields}
    # enforceSchema=False: a further file with other columns is an error, not shifted data.
    text = spark.read.csv(
        path,
        header=True,
        escape='"',
        multiLine=multiline,
        enforceSchema=False,
        mode="FAILFAST",
    )
    columns = []
    for name in text.columns:
        value = F.col(f"`{name}`")
        value = F.when(~value.isin(*MISSING_MARKERS), value)
        columns.append(_typed(value, types.get(name, T.StringType())).alias(name))
    return text.select(*columns)


def _typed(value: Column, wanted: T.DataType) -> Column:
    if wanted == T.StringType():
        return value
    if wanted == T.TimestampNTZType():
        return parse_timestamp(value)
    if isinstance(wanted, T.IntegralType):
        rounded = F.round(value.try_cast("decimal(38,9)"), 0).try_cast(wanted)
        return F.coalesce(value.try_cast(wanted), rounded)
    return value.try_cast(wanted)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_checked_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A parquet folder of which every file has a footer that can be read, or an error.

    Spark lists the files and reads their footers in a job, many files per task; the schema
    is that of all of them together.
    """
    return spark.read.option("mergeSchema", True).parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


class Loaded(NamedTuple):
    """Data, which source it came from, and why not from the primary one."""

    df: DataFrame
    source: str
    cause: str | None = None


# What Spark says of a file that is no file of its format or has another header; other
# failures while reading, such as a lost executor or a store that is busy, say nothing about
# the source.
_WRONG_FORMAT = (
    "is not a Parquet file",
    "Could not read footer",
    "CANNOT_READ_FILE_FOOTER",
    "UNABLE_TO_INFER_SCHEMA",
    "CSV header does not conform to the schema",
)
# Analysis errors that speak of the source; any other one is a mistake in the reader.
_NO_SOURCE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def load_or_else(
    primary: Callable[[], DataFrame],
    fallback: Callable[[], DataFrame],
    required: tuple[str, ...] = KEYS,
) -> Loaded:
    """The primary source, or the fallback if there is no such source.

    Only a missing path, a missing column or a file of another format leads to the
    fallback; the cause is returned and logged. Any other error is raised: a job must not
    go on with invented rows because an executor was lost. So is a mistake in the reader, such
    as a column it names wrongly. Reads are lazy, so the primary's first row is read here;
    ``read_checked_parquet`` and ``typed.read_csv_typed`` have looked at every file by then.
    """
    try:
        df = primary()
        absent = [name for name in required if name not in df.columns]
        if not absent:
            df.take(1)
            return Loaded(df, "primary")
        cause = f"columns {absent} are missing"
    except AnalysisException as error:
        if error.getCondition() not in _NO_SOURCE:
            raise
        cause = str(error)
    except (PySparkException, Py4JJavaError) as error:
        if not any(mark in str(error) for mark in _WRONG_FORMAT):
            raise
        cause = str(error)
    log.warning("the fallback is used: %s", cause.splitlines()[0])
    return Loaded(fallback(), "fallback", cause)
