"""Several tables published together: readers see all of one version, or all of the next.

Each version is a folder of its own. What makes it current is one row in a small table beside
the versions, appended after all tables are written. Spark moves that row's file into place
in one step, so there is no moment at which a reader finds one table of the new version and
one of the old. A failure before it leaves the old version current and its files untouched.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewarden.session import remove_folder

VERSIONS, POINTER = "versions", "current"
POINTER_SCHEMA = "number long, version string, tables array<string>"


class NothingPublished(LookupError):
    """The folder has no version yet."""


def _history(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(POINTER_SCHEMA).parquet(f"{root}/{POINTER}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _latest(spark: SparkSession, root: str):
    history = _history(spark, root)
    return history and history.orderBy(F.desc("number"), F.desc("version")).first()


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write all tables as a new version, make it current and return it as written.

    Of two publishers at a time, the one that ends last wins with all its tables.
    """
    version = uuid.uuid4().hex
    folder = f"{root}/{VERSIONS}/{version}"
    try:
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}")
    except BaseException:
        remove_folder(spark, folder)
        raise
    last = _latest(spark, root)
    row = [((last["number"] if last else 0) + 1, version, list(tables))]
    pointer = spark.createDataFrame(row, POINTER_SCHEMA).coalesce(1)
    pointer.write.mode("append").parquet(f"{root}/{POINTER}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in tables}


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the current version.

    They stay readable while newer versions are published, until the version is dropped.
    """
    last = _latest(spark, root)
    if not last:
        raise NothingPublished(root)
    folder = f"{root}/{VERSIONS}/{last['version']}"
    return {name: spark.read.parquet(f"{folder}/{name}") for name in last["tables"]}


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete the versions before the last ``keep`` that were published; how many went.

    Versions that are being written are not touched, as nothing names them yet.
    """
    history = _history(spark, root)
    if history is None:
        return 0
    newest = F.desc("number"), F.desc("version")
    kept = [r["version"] for r in history.orderBy(*newest).limit(max(keep, 1)).collect()]
    old = [r["version"] for r in history.filter(~F.col("version").isin(kept)).collect()]
    for version in old:
        remove_folder(spark, f"{root}/{VERSIONS}/{version}")
    return len(old)
