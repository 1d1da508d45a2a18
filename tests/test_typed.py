from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from linewarden.functions.times import ISO, column_format
from linewarden.operators.clean import clean_outages
from linewarden.sources import readers
from linewarden.sources.typed import read_csv_typed, type_columns


def dates(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "onset_dt string")


def test_one_day_first_text_settles_the_column(spark):
    found = column_format(dates(spark, "03/02/2024", "04/05/2024", "13/02/2024", None), "onset_dt")
    assert (found.name.split("[")[0], found.unread) == ("d/M/yyyy", 0)
    found = column_format(dates(spark, "03/02/2024", "02/13/2024", "?"), "onset_dt")
    assert (found.name.split("[")[0], found.unread) == ("M/d/yyyy", 1)


def test_ties_iso_and_nothing(spark):
    assert column_format(dates(spark, "03/02/2024"), "onset_dt").name.startswith("M/d")
    assert column_format(dates(spark, "2024-02-03", "2024-02-03 01:02:03"), "onset_dt") == (ISO, 0)
    assert column_format(dates(spark, None, "no"), "onset_dt") == (ISO, 1)
    assert column_format(dates(spark).limit(0), "onset_dt") == (ISO, 0)


def test_cleaning_reads_the_column_in_its_format(spark):
    raw = spark.createDataFrame(
        [("1", "ON", "03/02/2024"), ("2", "ON", "13/02/2024"), ("3", "ON", "2024-02-03")],
        "outage_id string, province string, onset_dt string",
    )
    found = column_format(raw, "onset_dt")
    rows = clean_outages(raw, found.name).orderBy("outage_id").collect()
    assert [r.onset_dt for r in rows] == [dt.datetime(2024, 2, 3), dt.datetime(2024, 2, 13), None]
    assert [r.month for r in rows] == [2, 2, None] and found.unread == 1


def test_csv_keeps_fractions_and_rejects(spark, tmp_path):
    file = tmp_path / "outages.csv"
    file.write_bytes(
        "﻿province,outage_id,remark,duration_min,onset_dt,customers_affected\n"
        'MB,OUT-1,"said ""hello"", twice",90,03/02/2022,5\n'
        "NA,OUT-2,,n/a,13/02/2022 10:11,7.0\n"
        " on ,OUT-3,x,12.5,soon,many\n"
        "QC,OUT-4,,Infinity,14/02/2022,1e3\n"
        "QC,OUT-5,too,few\n"
        "QC,OUT-6,,1,15/02/2022,2,too many\n".encode()
    )
    rows, rejects, columns = read_csv_typed(spark, str(file))
    assert dict(rows.dtypes) == {
        "province": "string", "outage_id": "string", "remark": "string",
        "duration_min": "double", "onset_dt": "timestamp_ntz", "customers_affected": "bigint",
    }
    got = {r.outage_id: r for r in rows.collect()}
    assert sorted(got) == ["OUT-1", "OUT-2", "OUT-3", "OUT-4"]
    assert [got[k].duration_min for k in sorted(got)] == [90.0, None, 12.5, None]
    assert [got[k].customers_affected for k in sorted(got)] == [5, 7, None, 1000]
    assert got["OUT-1"].onset_dt == dt.datetime(2022, 2, 3)
    assert got["OUT-1"].remark == 'said "hello", twice' and got["OUT-2"].province is None
    faults = {
        (r.outage_id, f.column, f.value, f.type) for r in rejects.collect() for f in r.rejected
    }
    assert {f for f in faults if f[3] != "record"} == {
        ("OUT-3", "onset_dt", "soon", "timestamp_ntz"),
        ("OUT-3", "customers_affected", "many", "bigint"),
        ("OUT-4", "duration_min", "Infinity", "double"),
    }
    whole = {f[2] for f in faults if f[3] == "record"}
    assert whole == {"QC,OUT-5,too,few", "QC,OUT-6,,1,15/02/2022,2,too many"}
    assert columns["onset_dt"].rejected == 1 and columns["duration_min"].rejected == 1
    assert rows.count() + len(whole) == 6


def test_whole_numbers_stay_whole(spark):
    text = spark.createDataFrame([("1", "90.0"), ("2", "9" * 25)], "outage_id string, duration_min string")
    rows, rejects, columns = type_columns(text)
    assert dict(rows.dtypes)["duration_min"] == "bigint"
    assert [r.duration_min for r in rows.orderBy("outage_id").collect()] == [90, None]
    assert rejects.first().rejected[0].value == "9" * 25 and rejects.count() == 1


def test_no_rows_and_no_typed_columns(spark):
    text = spark.createDataFrame([], "outage_id string, duration_min string")
    rows, rejects, columns = type_columns(text)
    assert rows.count() == rejects.count() == 0
    rows, rejects, _ = type_columns(spark.createDataFrame([("x",)], "remark string"))
    assert rows.count() == 1 and rejects.count() == 0


def backup(spark):
    return spark.createDataFrame([("b", "ON")], "outage_id string, province string")


def test_a_broken_third_file_is_found_before_the_job(spark, tmp_path):
    folder = tmp_path / "records"
    good = spark.range(30).select(
        F.col("id").cast("string").alias("outage_id"), F.lit("ON").alias("province")
    )
    good.repartition(2).write.parquet(str(folder))
    loaded = readers.load_or_else(
        lambda: readers.read_checked_parquet(spark, str(folder)), lambda: backup(spark)
    )
    assert loaded.source == "primary" and loaded.df.count() == 30
    (folder / "part-99999.parquet").write_bytes(b"not parquet at all")
    loaded = readers.load_or_else(
        lambda: readers.read_checked_parquet(spark, str(folder)), lambda: backup(spark)
    )
    assert (loaded.source, loaded.df.count()) == ("fallback", 1) and loaded.cause


def test_a_further_csv_file_with_another_header_is_found(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("outage_id,province\n1,ON\n2,QC\n")
    (folder / "b.csv").write_text("outage_id,province\n3,ON\n")
    (folder / "c.csv").write_text("province,city\nON,x\n")
    loaded = readers.load_or_else(
        lambda: read_csv_typed(spark, str(folder)).rows, lambda: backup(spark)
    )
    assert loaded.source == "fallback" and "header" in loaded.cause


def test_a_mistake_in_the_reader_is_no_reason_for_the_fallback(spark):
    with pytest.raises(AnalysisException, match="no_such"):
        readers.load_or_else(lambda: backup(spark).select("no_such"), lambda: backup(spark))
