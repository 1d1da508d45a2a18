"""Shared-folder helpers: where intermediate results are written, and their removal."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# The scopes that are open, innermost last; scratch of a scope goes when the scope ends.
_scopes: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as named in ``spark.checkpoint.dir``.

    On a cluster that setting is required. A local master without it, as in a trial, uses a
    folder below the warehouse.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def application_folder(spark: SparkSession) -> str:
    """Where everything this application writes down in between lies."""
    return f"{shared_folder(spark)}/linewarden/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return "/".join([application_folder(spark), *_scopes, uuid.uuid4().hex, name])


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies; nothing happens if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch of the application, at the end of a job.

    DataFrames that still read it can no longer be used.
    """
    remove_folder(spark, application_folder(spark))


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch written inside is deleted at the end, also after an error."""
    scope = uuid.uuid4().hex
    folder = "/".join([application_folder(spark), *_scopes, scope])
    _scopes.append(scope)
    try:
        yield
    finally:
        _scopes.remove(scope)
        remove_folder(spark, folder)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back.

    Cuts the lineage at a table that outlives any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
