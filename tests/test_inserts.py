"""Insert-or-ignore against a one-by-one insert."""

from __future__ import annotations

import random

import pytest

from linewarden import model
from linewarden.operators import generate, quality
from linewarden.sources import catalog, inserts

SCHEMA = "n int, a int, b int, c int, v int"


def one_by_one(stored, rows, keys, valid=lambda row: True):
    """What a row-at-a-time insert keeps; rows are dicts."""
    seen = [{tuple(r[c] for c in key) for r in stored} for key in keys]
    kept = []
    for row in sorted(rows, key=lambda r: r["n"]):
        values = [tuple(row[c] for c in key) for key in keys]
        clash = any(None not in v and v in seen[i] for i, v in enumerate(values))
        if clash or not valid(row):
            continue
        for i, value in enumerate(values):
            seen[i].add(value)
        kept.append(tuple(row.values()))
    return sorted(map(repr, kept))


def frame(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)


def random_rows(rng, count, high, start=0):
    def value():
        return rng.choice([None, *range(high)])

    numbers = rng.sample(range(start, start + 10 * count), count)
    return [
        {"n": n, "a": rng.randrange(high), "b": value(), "c": value(), "v": rng.randrange(-2, 9)}
        for n in numbers
    ]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize(
    "keys", [[("a",)], [("b", "c")], [("a",), ("b",)], [("a",), ("b", "c"), ("c",)]]
)
def test_matches_one_by_one_insert(spark, seed, keys):
    rng = random.Random(seed)
    stored = random_rows(rng, 5, 14)
    rows = random_rows(rng, 60, 14, start=1000)
    accepted = inserts.insert_or_ignore(frame(spark, stored), frame(spark, rows), keys, ["n"])
    assert sorted(repr(tuple(r)) for r in accepted.collect()) == one_by_one(stored, rows, keys)


def chains(count, length):
    """Rows that each clash with the one before them in their chain."""
    return [
        {"n": chain * length + i, "a": 2 * chain * length + (i + 1) // 2 * 2,
         "b": 2 * chain * length + i // 2 * 2, "c": 0, "v": 0}
        for chain in range(count)
        for i in range(length)
    ]


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_components_of_any_size(spark, most, monkeypatch):
    monkeypatch.setattr(inserts._first_per_keys, "__defaults__", (most,))
    rng = random.Random(most)
    rows = chains(5, 9) + chains(1, 40)[15:]
    rows = [{**r, "n": i} for i, r in enumerate(rng.sample(rows, len(rows)))]
    rows += random_rows(rng, 40, 30, start=1000)
    keys = [("a",), ("b",)]
    accepted = inserts.insert_or_ignore(frame(spark, []), frame(spark, rows), keys, ["n"])
    assert sorted(repr(tuple(r)) for r in accepted.collect()) == one_by_one([], rows, keys)


def test_large_batch_of_short_chains_takes_few_jobs(spark, monkeypatch):
    rows = chains(10_000, 10)
    batch = frame(spark, rows)
    written = []
    real = inserts.materialize
    monkeypatch.setattr(inserts, "materialize", lambda df, n: written.append(n) or real(df, n))
    keys = [("a",), ("b",)]
    accepted = inserts.insert_or_ignore(frame(spark, []), batch, keys, ["n"])
    assert sorted(repr(tuple(r)) for r in accepted.collect()) == one_by_one([], rows, keys)
    resolving = [n for n in written if n not in ("insert_rows", "insert_clashes")]
    assert len(resolving) < 10 and resolving.count("insert_round") == 1, written


def test_settled_rows_are_written_once(spark, monkeypatch):
    """Pairs that clash are settled by the first row; no step after it sees their rows again."""
    rows = [{"n": i, "a": i // 2, "b": i, "c": 0, "v": 0} for i in range(400)]
    rows += [{"n": i, "a": i, "b": i // 2, "c": 0, "v": 0} for i in range(1000, 1400)]
    written = []
    real = inserts.materialize

    def counted(df, name):
        stored = real(df, name)
        written.append((name, stored.count()))
        return stored

    monkeypatch.setattr(inserts, "materialize", counted)
    keys = [("a",), ("b",)]
    accepted = inserts.insert_or_ignore(frame(spark, []), frame(spark, rows), keys, ["n"])
    assert sorted(repr(tuple(r)) for r in accepted.collect()) == one_by_one([], rows, keys)
    assert sum(n for _, n in written) <= len(rows) + accepted.count(), written


def test_values_of_equal_keys_stay_as_they_came(spark):
    """0.0 and -0.0 are one key, and the row that stays keeps its own."""
    rows = spark.createDataFrame([(2, 0.0, 1), (1, -0.0, 2)], "n int, x double, y int")
    accepted = inserts.insert_or_ignore(rows.limit(0), rows, [("x",)], ["n"]).collect()
    assert [(r.n, str(r.x), r.y) for r in accepted] == [(1, "-0.0", 2)]


def test_rejected_row_does_not_block_a_later_one(spark):
    rows = [
        {"n": 1, "a": 1, "b": 1, "c": 0, "v": 0},
        {"n": 2, "a": 2, "b": 1, "c": 0, "v": 0},
        {"n": 3, "a": 2, "b": 2, "c": 0, "v": 0},
        {"n": 4, "a": 3, "b": 2, "c": 0, "v": 0},
        {"n": 5, "a": 3, "b": 3, "c": 0, "v": 0},
    ]
    accepted = inserts.insert_or_ignore(
        frame(spark, []), frame(spark, rows), [("a",), ("b",)], ["n"]
    )
    assert sorted(r.n for r in accepted.collect()) == [1, 3, 5]


def test_identical_rows_are_inserted_once(spark):
    row = {"n": 1, "a": 1, "b": 1, "c": 1, "v": 1}
    for keys in ([("a",)], [("a",), ("b",)]):
        accepted = inserts.insert_or_ignore(
            frame(spark, []), frame(spark, [row] * 3), keys, ["n"]
        )
        assert accepted.count() == 1


def test_broken_rules_skip_the_row(spark):
    rng = random.Random(9)
    rows = random_rows(rng, 40, 10)
    rules = [quality.not_null("b"), quality.holds("positive", "v >= 0")]
    accepted = inserts.insert_or_ignore(
        frame(spark, []), frame(spark, rows), [("a",)], ["n"], rules
    )
    expected = one_by_one([], rows, [("a",)], lambda r: r["b"] is not None and r["v"] >= 0)
    assert sorted(repr(tuple(r)) for r in accepted.collect()) == expected


def test_append_is_idempotent_and_checks_parents(spark, tmp_path):
    catalog.create_database(spark, "insert_test", str(tmp_path / "db"), replace=True)
    catalog.create_tables(spark, "insert_test")
    name = "insert_test.engineer"
    rows = generate.engineers(generate.ids(spark, 50))
    province = {"province": model.lookup(spark, "province")}
    table = model.ENGINEER
    assert inserts.append_or_ignore(spark, table, name, rows, ["engineer_id"], province) == 50
    assert inserts.append_or_ignore(spark, table, name, rows, ["engineer_id"], province) == 0
    more = generate.engineers(generate.ids(spark, 60))
    assert inserts.append_or_ignore(spark, table, name, more, ["engineer_id"], province) == 10
    stored = spark.table(name)
    assert stored.count() == 60
    assert stored.filter("created_at is null or is_oncall is null").count() == 0

    from pyspark.sql import functions as F

    stray = generate.engineers(generate.ids(spark, 61)).withColumn("province_code", F.lit("ZZ"))
    with pytest.raises(inserts.MissingParent):
        inserts.append_or_ignore(spark, table, name, stray, ["engineer_id"], province)
    assert spark.table(name).count() == 60
    with pytest.raises(ValueError, match="engineer_id"):
        inserts.append_or_ignore(spark, table, name, rows.drop("engineer_id"), ["employee_no"])
    spark.catalog.setCurrentDatabase("default")


def test_key_lookup(spark):
    stored = spark.createDataFrame([(7, "x"), (8, "y")], "id int, code string")
    rows = spark.createDataFrame([("y",), ("z",)], "code string")
    found = inserts.key_of(rows, stored, ("code",), "id")
    assert {tuple(r) for r in found.collect()} == {("y", 8), ("z", None)}
    with pytest.raises(inserts.MissingParent, match="z"):
        inserts.require_keys(found, ("code",), "id")
    known = found.filter("code = 'y'")
    assert inserts.require_keys(known, ("code",), "id").count() == 1


def test_long_chain_of_clashes(spark):
    """Row i clashes with row i - 1: every second row stays, after half as many rounds."""
    rows = [{"n": i, "a": i // 2, "b": (i + 1) // 2, "c": 0, "v": 0} for i in range(24)]
    accepted = inserts.insert_or_ignore(
        frame(spark, []), frame(spark, rows), [("a",), ("b",)], ["n"]
    )
    assert sorted(r.n for r in accepted.collect()) == list(range(0, 24, 2))


def test_hundreds_of_chains_take_one_round(spark, monkeypatch):
    rows = [
        {"n": 4 * c + i, "a": 10 * c + i // 2, "b": 10 * c + (i + 1) // 2, "c": 0, "v": 0}
        for c in range(200)
        for i in range(4)
    ]
    written = []
    plain = inserts.materialize
    monkeypatch.setattr(
        inserts, "materialize", lambda df, name: written.append(name) or plain(df, name)
    )
    accepted = inserts.insert_or_ignore(
        frame(spark, []), frame(spark, rows), [("a",), ("b",)], ["n"]
    )
    assert sorted(r.n for r in accepted.collect()) == list(range(0, 800, 2))
    # The rest of each chain is settled in one task.
    assert written.count("insert_round") == 1
