"""Each rule on clean rows and on rows with planted faults."""

from __future__ import annotations

from decimal import Decimal

from linewarden import model
from linewarden.operators import quality


def violations(df):
    return {(r.rule, r.subject): r.violations for r in df.collect()}


def test_keys_in_one_pass(spark):
    rows = [
        (1, "x", 1, 1),
        (1, "y", 1, 2),
        (2, None, 1, 2),
        (None, None, None, 2),
        (None, "x", None, 2),
    ]
    df = spark.createDataFrame(rows, "id int, code string, a int, b int")
    summary = quality.check_keys(df, "t", "id", (("code",), ("a", "b")))
    assert violations(summary) == {
        ("primary_key_null", "id"): 2,
        ("primary_key_duplicate", "id"): 1,
        ("unique", "code"): 1,
        ("unique", "a, b"): 1,
    }
    assert quality.repeated_rows(df, ("code",)).count() == 2
    empty = quality.check_keys(df.limit(0), "t", "id", (("code",),))
    assert set(violations(empty).values()) == {0}


def test_row_rules(spark):
    df = spark.createDataFrame(
        [("LEAD", 5, "abc", 12.5), ("BOSS", -1, "abcd", 1000.0), (None, None, None, None)],
        "role string, n int, code string, lat double",
    )
    rules = [
        quality.not_null("n"),
        quality.in_domain("role", model.ROLES),
        quality.holds("positive", "n >= 0"),
        quality.max_length("code", 3),
        quality.fits_decimal("lat", model.COORDINATE),
    ]
    assert violations(quality.check_rows(df, "t", rules)) == {
        ("not_null", "n"): 1,
        ("domain", "role"): 1,
        ("check", "positive"): 1,
        ("length", "code"): 1,
        ("decimal", "lat"): 1,
    }
    offending = quality.offending_rows(df, rules)
    assert offending.count() == 5
    assert offending.columns == ["role", "n", "code", "lat", "rule", "subject"]
    assert set(violations(quality.check_rows(df.limit(0), "t", rules)).values()) == {0}


def test_references_let_null_pass(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "p int")
    parent = spark.createDataFrame([(1,), (3,)], "id int")
    assert violations(quality.check_reference(child, "t", "p", parent, "id")) == {
        ("foreign_key", "p"): 2
    }
    assert quality.orphan_rows(child, "p", parent, "id").count() == 2
    assert violations(quality.check_rows(child, "t", [quality.in_lookup("p", "outage_type")])) == {
        ("foreign_key", "p"): 0
    }


def test_derived_duration(spark):
    df = spark.sql(
        """
        SELECT * FROM VALUES
          (timestamp_ntz'2024-01-01 00:00:00', timestamp_ntz'2024-01-01 00:02:30', 3),
          (timestamp_ntz'2024-01-01 00:00:00', timestamp_ntz'2024-01-01 00:02:30', 2),
          (timestamp_ntz'2024-01-01 00:00:00', NULL, NULL),
          (timestamp_ntz'2024-01-01 00:00:00', NULL, 4)
          AS t(reported_at, resolved_at, duration_min)
        """
    )
    rule = quality.equals_derived("duration_min", model.OUTAGE_INCIDENT.derived["duration_min"]())
    assert violations(quality.check_rows(df, "t", [rule])) == {("derived", "duration_min"): 2}


def test_declared_rules_cover_the_model():
    assert list(model.TABLES) == [
        "province",
        "outage_type",
        "severity_level",
        "resolution_action",
        "carrier",
        "tower",
        "engineer",
        "outage_incident",
        "incident_assignment",
        "resolution_log",
        "extract_link",
    ]
    for table in model.TABLES.values():
        names = {c.name for c in table.columns}
        for key in table.unique_keys:
            assert set(key) <= names
        for column, (parent, parent_column) in table.references.items():
            assert column in names
            assert parent_column == model.TABLES[parent].primary_key


def test_lookups_match_their_schema(spark):
    for name in model.LOOKUPS:
        df = model.lookup(spark, name)
        assert df.count() == len(model.lookup_keys(name))
        summary = quality.validate(model.TABLES[name], df, {})
        assert summary.filter("violations > 0").count() == 0


def test_decimal_of_the_schema_is_exact(spark):
    row = spark.range(1).selectExpr("cast(-113.123456 as decimal(9,6)) lon").first()
    assert row.lon == Decimal("-113.123456")
