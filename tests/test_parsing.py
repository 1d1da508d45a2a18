"""Golden rows for log parsing and cleaning."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from linewarden.functions import text, times
from linewarden.operators.clean import clean_outages
from linewarden.operators.logs import parse_logs

# text, engineer, minutes, escalation
LOGS = [
    (
        "Technician Anna Marie Smith attended site at 10:02:33. Issue: x. Customers restored "
        "after 45 minutes.",
        "Anna Marie Smith",
        45,
        False,
    ),
    ("ESCALATION – John Doe – outage ref OUT-0007. Crew dispatched.", "John Doe", None, True),
    (
        "Alert on node NODE-100. On-call engineer Mary Jones paged. Resolved in 77 min.",
        "Mary Jones",
        77,
        False,
    ),
    ("Field report by Luc Roy: attended Lake Tina exchange. x.", "Luc Roy", None, False),
    ("Field report by Luc O'Brien: attended X exchange.", "Unknown", None, False),
    ("Technician Cher attended", "Unknown", None, False),
    ("Technician Dr. Anna Smith attended. 12 minor faults, 30 minutes", "Unknown", 12, False),
    ("de-escalated by Ann Lee-Roy: 5min", "Ann Lee", 5, True),
    ("Technician José García Smith attended", "Unknown", None, False),
    ("Technician Anna  Smith", "Unknown", None, False),
    ("Technician Anna Smith Issue", "Anna Smith Issue", None, False),
    ("", "Unknown", None, False),
    ("Technician Anna Smith left after 9 min", "Anna Smith", 9, False),
    ("٣ min", "Unknown", None, False),
    ("by Al Bo - 99999999999999999999 min", "Al Bo", None, False),
    ("minutes of the meeting", "Unknown", None, False),
    ("work was eſcalated", "Unknown", None, True),
    (None, None, None, None),
]


def test_golden_logs(spark):
    rows = [(str(i), row[0]) for i, row in enumerate(LOGS)]
    logs = spark.createDataFrame(rows, "outage_id string, log_text string")
    parsed = {
        int(r.outage_id): (r.engineer_name, r.log_duration_min, r.is_escalation)
        for r in parse_logs(logs).collect()
    }
    assert parsed == {i: row[1:] for i, row in enumerate(LOGS)}


def test_parser_agrees_with_python_on_random_texts(spark):
    rng = random.Random(5)
    pieces = [
        "Technician",
        "engineer",
        "by",
        "–",
        "Anna",
        "Smith",
        "Lee",
        "J",
        "mcCoy",
        ":",
        "-",
        "12",
        "min",
        "minutes",
        "Escalation",
        "site",
        "7min",
    ]
    texts = [" ".join(rng.choices(pieces, k=rng.randint(1, 9))) for _ in range(3000)]
    logs = spark.createDataFrame(list(enumerate(texts)), "outage_id int, log_text string")
    for row in parse_logs(logs).collect():
        name = next(
            (m.group(1) for p in text.ENGINEER_PATTERNS if (m := re.search(p, row.log_text))),
            "Unknown",
        )
        minutes = re.search(text.DURATION_PATTERN, row.log_text)
        assert row.engineer_name == name, row.log_text
        assert row.log_duration_min == (int(minutes.group(1)) if minutes else None), row.log_text
        assert row.is_escalation == bool(re.search("escalat", row.log_text, re.I))


def test_clean_edge_rows(spark):
    raw = spark.createDataFrame(
        [
            ("OUT-1", "\t mb 　", "2022-03-05 10:11:12", 14401),
            ("OUT-2", "  ", "not a date", 14400),
            ("OUT-3", "on", None, None),
            (None, "ON", "2022-01-01", 1),
            ("OUT-4", None, "2022-01-01", 1),
        ],
        "outage_id string, province string, onset_dt string, duration_min bigint",
    )
    rows = {r.outage_id: r for r in clean_outages(raw).collect()}
    assert set(rows) == {"OUT-1", "OUT-2", "OUT-3"}
    first = rows["OUT-1"]
    assert (first.province, first.duration_min) == ("MB", 14400)
    assert first.onset_dt == dt.datetime(2022, 3, 5, 10, 11, 12)
    assert (first.year, first.month, first.weekday) == (2022, 3, "Saturday")
    assert (rows["OUT-2"].province, rows["OUT-2"].duration_min) == ("", 14400)
    assert (rows["OUT-2"].onset_dt, rows["OUT-2"].year, rows["OUT-2"].weekday) == (None,) * 3
    assert rows["OUT-3"].duration_min is None


def test_clean_optional_and_required_columns(spark):
    bare = spark.createDataFrame([("OUT-1", "mb")], "outage_id string, province string")
    assert [tuple(r) for r in clean_outages(bare).collect()] == [("OUT-1", "MB")]
    with pytest.raises(ValueError, match="province"):
        clean_outages(bare.drop("province"))


def test_clean_does_not_depend_on_the_session_zone(spark):
    raw = spark.createDataFrame(
        [("OUT-1", "ON", "2022-03-13 02:30:00")],
        "outage_id string, province string, onset_dt string",
    )
    spark.conf.set("spark.sql.session.timeZone", "America/Toronto")
    try:
        row = clean_outages(raw).first()
        assert row.onset_dt == dt.datetime(2022, 3, 13, 2, 30)
        minutes = raw.select(
            times.minutes_between(
                F.lit("2022-03-13 01:30:00").cast("timestamp_ntz"),
                F.lit("2022-03-13 03:30:00").cast("timestamp_ntz"),
            )
        ).first()[0]
        assert minutes == 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "seconds, minutes", [(0, 0), (29, 0), (30, 1), (150, 3), (149, 2), (86400 * 40 + 30, 57601)]
)
def test_minutes_round_halves_up(spark, seconds, minutes):
    start = F.lit("2022-01-01 00:00:00").cast("timestamp_ntz")
    end = F.timestamp_add("SECOND", F.lit(seconds), start)
    back = times.minutes_between(end, start)
    forth = times.minutes_between(start, end)
    assert tuple(spark.range(1).select(forth, back).first()) == (minutes, -minutes)


def test_padded_code_and_period(spark):
    row = (
        spark.createDataFrame([(7, 10001, None)], "a int, b int, c int")
        .select(
            text.padded_code("X-", F.col("a")).alias("a"),
            text.padded_code("X-", F.col("b")).alias("b"),
            times.period_label(F.col("b"), F.col("a")).alias("p"),
            times.period_label(F.col("c"), F.col("a")).alias("q"),
        )
        .first()
    )
    assert tuple(row) == ("X-0007", "X-10001", "10001-07", None)
