"""Synthetic outages, logs and model tables at any size.

Every generator maps rows of ids to rows of values with hash draws: no shuffle, and
the same values in any partitioning. Ids are dense and start at 1, so a child refers
to a uniformly drawn parent by number alone. A parent count may be a plain number or
a scalar subquery. Ids come from ``spark.range`` or from any table's dense key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linewarden import model
from linewarden import vocabulary as words
from linewarden.functions.draws import Draws
from linewarden.functions.text import fill, padded_code
from linewarden.functions.times import plus_minutes

# The ranges and odds the data is drawn from.
FIRST_DAY = "2022-01-01"
SPAN_DAYS = 730
DURATION_MU, DURATION_SIGMA, SHORTEST_MIN = 4.5, 1.2, 15
FEWEST_CUSTOMERS, MOST_CUSTOMERS = 50, 80_000
LOG_MINUTES = (30, 480)
NODE_NUMBERS = (100, 999)
LATITUDES, LONGITUDES = (42, 60), (-140, -52)
ONCALL_CHANCE, ESCALATED_CHANCE = 0.25, 0.28
SEVERITY_WEIGHTS = {1: 5, 2: 20, 3: 50, 4: 25}
MOST_SUPPORT = 2
PHONE_LENGTH = 20
NOTE_LENGTH = 8

AS_OF = "2025-01-01"


def ids(spark: SparkSession, n: int) -> DataFrame:
    """The ids 1 to n."""
    return spark.range(1, n + 1)


def _number(count: int | Column) -> Column:
    return count if isinstance(count, Column) else F.lit(count)


def _duration(d: Draws) -> Column:
    return d.lognormal_integer("duration", DURATION_MU, DURATION_SIGMA, SHORTEST_MIN)


def _full_name(d: Draws) -> Column:
    first, last = d.choice("first", words.FIRST_NAMES), d.choice("last", words.LAST_NAMES)
    return F.concat(first, F.lit(" "), last)


def outage_records(ids: DataFrame, seed: int = 42) -> DataFrame:
    """One outage record per id."""
    d = Draws(seed, F.col("id"))
    return ids.select(
        padded_code("OUT-", F.col("id")).alias("outage_id"),
        d.choice("province", words.PROVINCE_CODES).alias("province"),
        d.choice("city", words.CITIES).alias("city"),
        d.choice("cause", words.CAUSES).alias("outage_type"),
        d.minute_stamp("onset", FIRST_DAY, SPAN_DAYS).alias("onset_dt"),
        _duration(d).alias("duration_min"),
        d.integer("customers", FEWEST_CUSTOMERS, MOST_CUSTOMERS).alias("customers_affected"),
        d.choice("carrier", words.CARRIER_NAMES).alias("carrier"),
    )


def incident_logs(outages: DataFrame, seed: int = 42) -> DataFrame:
    """One free-text log per outage id."""
    d = Draws(seed, F.col("outage_id"))
    clock = [
        F.lpad(d.integer(f"time/{part}", 0, top).cast("string"), 2, "0")
        for part, top in (("hour", 23), ("minute", 59), ("second", 59))
    ]
    fields = {
        "name": _full_name(d),
        "time": F.concat_ws(":", *clock),
        "issue": d.choice("issue", words.ISSUES),
        "fix": d.choice("fix", words.FIXES),
        "mins": d.integer("minutes", *LOG_MINUTES),
        "ref": F.col("outage_id"),
        "node": F.concat(F.lit("NODE-"), d.integer("node", *NODE_NUMBERS).cast("string")),
        "city": d.choice("city", words.CITIES),
    }
    template = d.raw("template") % len(words.LOG_TEMPLATES)
    text = F.when(template == 0, fill(words.LOG_TEMPLATES[0], **fields))
    for number, body in enumerate(words.LOG_TEMPLATES[1:], start=1):
        text = text.when(template == number, fill(body, **fields))
    return outages.select("outage_id", text.alias("log_text"))


def towers(ids: DataFrame, seed: int = 7, as_of: str = AS_OF) -> DataFrame:
    """One tower per id, 1 to 15 years old."""
    d = Draws(seed, F.col("id"))
    province = d.choice("province", words.PROVINCE_CODES)
    site_type = d.choice("site", list(model.SITE_TYPES))
    prefix = F.concat(province, F.lit("-"), F.substring(site_type, 1, 3), F.lit("-"))
    return ids.select(
        F.col("id").alias("tower_id"),
        padded_code(prefix, F.col("id")).alias("tower_code"),
        d.integer("carrier", 1, len(model.CARRIERS)).cast("int").alias("carrier_id"),
        site_type.alias("site_type"),
        d.choice("city", words.CITIES).alias("city"),
        province.alias("province_code"),
        d.fixed_point("latitude", *LATITUDES, digits=6).alias("latitude"),
        d.fixed_point("longitude", *LONGITUDES, digits=6).alias("longitude"),
        d.days_before("commissioned", as_of, 365, 15 * 365).alias("commissioned_dt"),
    )


def engineers(ids: DataFrame, seed: int = 7, as_of: str = AS_OF) -> DataFrame:
    """One engineer per id, hired half a year to 12 years ago."""
    d = Draws(seed, F.col("id"))
    full_name = _full_name(d)
    person = F.lower(F.replace(full_name, F.lit(" "), F.lit(".")))
    mailbox = F.concat(person, F.col("id").cast("string"))
    parts = [
        d.integer(f"phone/{i}", low, high).cast("string")
        for i, (low, high) in enumerate(((200, 999), (200, 999), (1000, 9999), (1, 99999)))
    ]
    phone = F.concat(F.lit("+1 "), F.concat_ws("-", *parts[:3]), F.lit(" ext "), parts[3])
    return ids.select(
        F.col("id").alias("engineer_id"),
        padded_code("EMP-", F.col("id")).alias("employee_no"),
        full_name.alias("full_name"),
        F.concat(mailbox, F.lit("@example.org")).alias("email"),
        F.substring(phone, 1, PHONE_LENGTH).alias("phone"),
        d.choice("specialisation", list(model.SPECIALISATIONS)).alias("specialisation"),
        d.choice("province", words.PROVINCE_CODES).alias("province_code"),
        d.days_before("hired", as_of, 183, 12 * 365).alias("hire_date"),
        d.chance("oncall", ONCALL_CHANCE).alias("is_oncall"),
    )


def incidents(ids: DataFrame, tower_count: int | Column, seed: int = 7) -> DataFrame:
    """One resolved incident per id at a random tower."""
    d = Draws(seed, F.col("id"))
    drawn = ids.select(
        "id",
        d.minute_stamp("reported", FIRST_DAY, SPAN_DAYS).alias("reported_at"),
        _duration(d).cast("int").alias("duration_min"),
    )
    reported = F.col("reported_at")
    prefix = F.concat(F.lit("INC-"), F.year(reported).cast("string"), F.lit("-"))
    note = fill(
        words.ROOT_CAUSE_NOTE,
        cause=d.choice("root_cause", words.ROOT_CAUSES),
        city=d.choice("city", words.CITIES),
    )
    return drawn.select(
        F.col("id").alias("incident_id"),
        padded_code(prefix, F.col("id")).alias("incident_ref"),
        d.integer("tower", 1, _number(tower_count)).alias("tower_id"),
        d.integer("cause", 1, len(model.OUTAGE_TYPES)).cast("int").alias("outage_type_id"),
        d.weighted("severity", SEVERITY_WEIGHTS).alias("severity_id"),
        "reported_at",
        plus_minutes(reported, F.col("duration_min")).alias("resolved_at"),
        "duration_min",
        d.integer("customers", FEWEST_CUSTOMERS, MOST_CUSTOMERS).alias("customers_affected"),
        d.chance("escalated", ESCALATED_CHANCE).alias("is_escalated"),
        note.alias("root_cause_notes"),
    )


def assignments(ids: DataFrame, engineer_count: int | Column, seed: int = 7) -> DataFrame:
    """One lead and up to two supporters per incident id.

    An engineer drawn twice for an incident takes the earlier seat only, so the lead
    stays the lead. All seats of an incident sit in one row: nothing is shuffled.
    """
    d = Draws(seed, F.col("id"))
    seats = [d.integer(f"seat/{i}", 1, _number(engineer_count)) for i in range(1 + MOST_SUPPORT)]
    taken = d.integer("support", 0, MOST_SUPPORT).cast("int") + F.lit(1)
    crew = F.array_distinct(F.slice(F.array(*seats), F.lit(1), taken))
    pairs = ids.select(
        F.col("id").alias("incident_id"), F.posexplode(crew).alias("seat", "engineer_id")
    )
    incident, engineer = F.col("incident_id"), F.col("engineer_id")
    pair = F.concat_ws("-", incident.cast("string"), engineer.cast("string"))
    return pairs.select(
        ((incident - 1) * (1 + MOST_SUPPORT) + F.col("seat") + 1).alias("assignment_id"),
        "incident_id",
        "engineer_id",
        F.when(F.col("seat") == 0, "LEAD").otherwise("SUPPORT").alias("role"),
        Draws(seed, pair).minute_stamp("assigned", FIRST_DAY, SPAN_DAYS).alias("assigned_at"),
    )


def resolutions(ids: DataFrame, engineer_count: int | Column, seed: int = 7) -> DataFrame:
    """One resolution per incident id, by a random engineer."""
    d = Draws(seed, F.col("id"))
    sentence = F.concat_ws(
        " ", *[d.choice(f"word/{i}", words.NOTE_WORDS) for i in range(NOTE_LENGTH)]
    )
    first, rest = F.upper(F.substring(sentence, 1, 1)), F.substr(sentence, F.lit(2))
    return ids.select(
        F.col("id").alias("log_id"),
        F.col("id").alias("incident_id"),
        d.integer("action", 1, len(model.RESOLUTION_ACTIONS)).cast("int").alias("action_id"),
        d.integer("performer", 1, _number(engineer_count)).alias("performed_by"),
        d.minute_stamp("performed", FIRST_DAY, SPAN_DAYS).alias("performed_at"),
        F.concat(first, rest, F.lit(".")).alias("notes"),
    )


def links(ids: DataFrame, incident_count: int | Column, linked_at: str | None = None) -> DataFrame:
    """Each outage linked to an incident, round robin over the incidents."""
    when = F.lit(linked_at).cast("timestamp_ntz") if linked_at else F.localtimestamp()
    return ids.select(
        F.col("id").alias("link_id"),
        padded_code("OUT-", F.col("id")).alias("outage_id"),
        (F.lit(1) + (F.col("id") - 1) % _number(incident_count)).alias("incident_id"),
        when.alias("linked_at"),
        F.lit("Linked from the outage extract").alias("notes"),
    )
