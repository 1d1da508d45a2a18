"""The model's tables derived from the TPC-H-like test tables.

Each function reads whole tables. The modulo rules only choose values and plant
faults, such as a record without a date or an outage without a log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linewarden.functions.text import fill, padded_code, pick
from linewarden.functions.times import clock_text, timestamp_text
from linewarden.model import SITE_TYPES
from linewarden.vocabulary import (
    ALERT_LOG,
    CARRIER_NAMES,
    CAUSES,
    ESCALATION_LOG,
    FIELD_LOG,
    ISSUES,
    PROVINCE_CODES,
    TECHNICIAN_LOG,
)

ENGINEERS = [
    "Anna Smith",
    "Luc Roy",
    "Mary Ann Jones",
    "John Doe",
    "Luc O'Brien",
    "Cher",
    "Dr. Ann Lee",
]
SITE_CODES = ["CEL", "EXC", "DAT", "FIB"]

# Columns used of each test table; a declared schema saves the footer scan of inference.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, value double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def row_count(spark: SparkSession, sf_dir: str, name: str) -> Column:
    """Row count of a test table as a scalar subquery."""
    return table(spark, sf_dir, name).select(F.count("*")).scalar()


def outage_id(event_id: Column) -> Column:
    return padded_code("OUT-", event_id + 1)


def log_id(incident_id: Column, line: Column) -> Column:
    """A number of its own for each line of an incident, for up to 2**20 lines."""
    return incident_id * F.lit(2**20) + line


def _null_when(condition: Column, otherwise: Column) -> Column:
    return F.when(~condition, otherwise)


def outage_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw outage records, dirty on purpose, one per event."""
    event, user = F.col("event_id"), F.col("user_id")
    province = pick(PROVINCE_CODES, user % 10)
    onset = F.col("ts") + F.expr("(event_id % 700) * interval '1' day")
    return table(spark, sf_dir, "events").select(
        _null_when(event % 97 == 13, outage_id(event)).alias("outage_id"),
        _null_when(
            event % 101 == 17,
            F.when(event % 5 == 0, F.concat(F.lit(" "), F.lower(province), F.lit(" "))).otherwise(
                province
            ),
        ).alias("province"),
        F.concat(F.lit("City-"), (user % 50).cast("string")).alias("city"),
        pick(CAUSES, event % 6).alias("outage_type"),
        F.when(event % 89 == 7, F.lit("not a date"))
        .otherwise(timestamp_text(onset))
        .alias("onset_dt"),
        _null_when(event % 83 == 5, 15 + F.floor(F.col("value") * 60)).alias("duration_min"),
        (50 + (event * 7919) % 79951).alias("customers_affected"),
        pick(CARRIER_NAMES, user % 6).alias("carrier"),
    )


def incident_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One free-text log per event.

    One event in eleven speaks of an outage that does not exist, so its own has no log. One
    in thirteen speaks of the outage of the event before, which so has two logs.
    """
    event, user = F.col("event_id"), F.col("user_id")
    fields = {
        "name": pick(ENGINEERS, user % 7),
        "time": clock_text(F.col("ts")),
        "issue": pick(ISSUES, event % 6),
        "mins": 30 + event % 451,
        "ref": outage_id(event),
        "fix": F.lit("replaced UPS unit"),
        "node": F.concat(F.lit("NODE-"), (100 + event % 900).cast("string")),
        "city": F.lit("City"),
    }
    log_text = (
        F.when(event % 4 == 0, fill(TECHNICIAN_LOG, **fields))
        .when(event % 4 == 1, fill(ESCALATION_LOG, **fields))
        .when(event % 4 == 2, fill(ALERT_LOG, **fields))
        .otherwise(fill(FIELD_LOG, **fields))
    )
    return (
        table(spark, sf_dir, "events")
        .select(
            F.when(event % 11 == 3, F.concat(F.lit("STRAY-"), event.cast("string")))
            .when(event % 13 == 5, outage_id(event - 1))
            .otherwise(outage_id(event))
            .alias("outage_id"),
            log_text.alias("log_text"),
        )
    )


def tower(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    province = pick(PROVINCE_CODES, F.col("s_nationkey") % 10)
    prefix = F.concat(province, F.lit("-"), pick(SITE_CODES, key % 4), F.lit("-"))
    return table(spark, sf_dir, "supplier").select(
        (key + 1).alias("tower_id"),
        padded_code(prefix, key + 1).alias("tower_code"),
        (1 + key % 6).cast("int").alias("carrier_id"),
        pick(list(SITE_TYPES), key % 4).alias("site_type"),
        F.concat(F.lit("City-"), (key % 7).cast("string")).alias("city"),
        province.alias("province_code"),
    )


def engineer(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        (key + 1).alias("engineer_id"),
        padded_code("EMP-", key + 1, 9).alias("employee_no"),
        F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("specialisation"),
        pick(PROVINCE_CODES, F.col("c_nationkey") % 10).alias("province_code"),
        (key % 4 == 0).alias("is_oncall"),
    )


def outage_incident(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, reported = F.col("o_orderkey"), F.col("o_orderdate")
    minutes = F.when(
        F.col("o_orderstatus") != "O", 15 + F.floor(F.col("o_totalprice")) % 6000
    ).cast("int")
    reference = F.concat(F.lit("INC-"), F.year(reported).cast("string"), F.lit("-"))
    return table(spark, sf_dir, "orders").select(
        (key + 1).alias("incident_id"),
        padded_code(reference, key + 1, 9).alias("incident_ref"),
        (1 + key % row_count(spark, sf_dir, "supplier")).alias("tower_id"),
        (1 + F.col("o_custkey") % 6).cast("int").alias("outage_type_id"),
        F.when(F.col("o_orderpriority").startswith("1"), 1)
        .when(F.col("o_orderpriority").startswith("2"), 2)
        .when(F.col("o_orderpriority").startswith("3"), 3)
        .otherwise(4)
        .alias("severity_id"),
        reported.alias("reported_at"),
        F.timestamp_add("MINUTE", minutes, reported).alias("resolved_at"),
        minutes.alias("duration_min"),
        (50 + (key * 7919) % 79951).alias("customers_affected"),
        (key % 25 < 7).alias("is_escalated"),
    )


def incident_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assignments from line items; every second engineer, from the second on, has none."""
    engineers = row_count(spark, sf_dir, "customer")
    drawn = F.col("l_partkey") % engineers
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            (F.col("l_orderkey") + 1).alias("incident_id"),
            (1 + drawn - drawn % 2).alias("engineer_id"),
            "l_linenumber",
        )
        .groupBy("incident_id", "engineer_id")
        .agg(F.min("l_linenumber").alias("first_line"))
        .select(
            "incident_id",
            "engineer_id",
            F.when(F.col("first_line") == 1, "LEAD").otherwise("SUPPORT").alias("role"),
        )
    )


def resolution_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    engineers = row_count(spark, sf_dir, "customer")
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            (F.col("l_orderkey") + 1).alias("incident_id"),
            (1 + F.col("l_partkey") % 8).cast("int").alias("action_id"),
            (1 + F.col("l_suppkey") % engineers).alias("performed_by"),
            F.col("l_shipdate").alias("performed_at"),
            "l_linenumber",
        )
        .groupBy("incident_id", "action_id")
        .agg(F.min(F.struct("l_linenumber", "performed_by", "performed_at")).alias("first"))
        .select(
            log_id(F.col("incident_id"), F.col("first.l_linenumber")).alias("log_id"),
            "incident_id",
            "action_id",
            "first.performed_by",
            "first.performed_at",
        )
    )


def extract_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outages linked to incidents, round robin; one outage in nineteen to none."""
    event = F.col("event_id")
    incident = 1 + event % row_count(spark, sf_dir, "orders")
    return table(spark, sf_dir, "events").select(
        outage_id(event).alias("outage_id"),
        _null_when(event % 19 == 4, incident).alias("incident_id"),
    )


# Tables with planted rule faults.


def bad_incident(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents with missing, repeated and dangling keys and broken values."""
    key, tower_key = F.col("incident_id"), F.col("tower_id")
    return outage_incident(spark, sf_dir).select(
        F.when(key % 997 == 5, F.lit(None))
        .when(key % 499 == 3, key - 1)
        .otherwise(key)
        .alias("incident_id"),
        F.when(key % 211 == 4, -tower_key)
        .when(key % 307 == 2, F.lit(None))
        .otherwise(tower_key)
        .alias("tower_id"),
        "severity_id",
        "reported_at",
        F.when(key % 401 == 1, F.col("reported_at"))
        .otherwise(F.col("resolved_at"))
        .alias("resolved_at"),
        F.when(key % 53 == 2, F.col("duration_min") + 1)
        .otherwise(F.col("duration_min"))
        .alias("duration_min"),
        F.when(key % 301 == 9, -F.col("customers_affected"))
        .otherwise(F.col("customers_affected"))
        .alias("customers_affected"),
    )


def bad_engineer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engineers with repeated numbers and e-mails, unknown provinces and long phone numbers."""
    key = F.col("c_custkey")
    mail_key = F.when(key % 301 == 7, key - 1).otherwise(key)
    return table(spark, sf_dir, "customer").select(
        (key + 1).alias("engineer_id"),
        padded_code("EMP-", F.when(key % 401 == 3, key).otherwise(key + 1), 9).alias("employee_no"),
        _null_when(key % 83 == 11, F.col("c_name")).alias("full_name"),
        _null_when(
            key % 59 == 4, F.concat(F.lit("e"), mail_key.cast("string"), F.lit("@example.org"))
        ).alias("email"),
        F.concat("c_name", F.lit("-"), F.col("c_nationkey").cast("string")).alias("phone"),
        F.when(key % 71 == 6, F.lit("ZZ"))
        .when(key % 73 == 8, F.lit(None))
        .otherwise(pick(PROVINCE_CODES, F.col("c_nationkey") % 10))
        .alias("province_code"),
    )


def bad_tower(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Towers with unknown site types, missing cities and impossible coordinates."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        (key + 1).alias("tower_id"),
        F.when(key % 9 == 4, F.lit("ROOF_MAST"))
        .when(key % 31 == 2, F.lit(None))
        .otherwise(pick(list(SITE_TYPES), key % 4))
        .alias("site_type"),
        _null_when(key % 17 == 3, F.col("s_name")).alias("city"),
        F.col("s_acctbal").alias("latitude"),
        (F.col("s_acctbal") / 10).alias("longitude"),
    )


def bad_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assignments before any repeat of an incident and engineer pair is dropped."""
    engineers = row_count(spark, sf_dir, "customer")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") + 1).alias("incident_id"),
        (1 + F.col("l_partkey") % engineers).alias("engineer_id"),
        F.when(F.col("l_linenumber") == 1, "LEAD")
        .when(F.col("l_linenumber") == 7, "OBSERVER")
        .otherwise("SUPPORT")
        .alias("role"),
        F.col("l_shipdate").alias("assigned_at"),
    )
