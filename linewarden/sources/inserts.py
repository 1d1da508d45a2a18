"""Insert-or-ignore: append the rows that break no rule, keep what is there.

Rows are taken in arrival order. A row is skipped if it lacks a required value, breaks
a check, or shares a primary or unique key with a stored row or with an earlier row
that was itself accepted. Running the same insert again therefore adds nothing. A
missing parent row is an error, not a reason to skip.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden import model
from linewarden.operators import quality
from linewarden.session import materialize, scratch_scope
from linewarden.sources.catalog import with_defaults
from linewarden.sources.key_index import KeyIndex, extend_index, met_keys, open_index

Key = tuple[str, ...]

# Rows of a clash component that one task settles row by row.
MOST_IN_TASK = 1000
# Types whose equal values are identical, unlike 0.0 and -0.0.
EXACT = (T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


class MissingParent(ValueError):
    """Rows refer to parents that do not exist."""


def insert_or_ignore(
    stored: DataFrame,
    incoming: DataFrame,
    keys: list[Key],
    arrival: list[str],
    rules: list[quality.RowRule] | None = None,
    indexes: dict[Key, KeyIndex] | None = None,
) -> DataFrame:
    """The incoming rows an insert-or-ignore accepts.

    ``arrival`` names the columns that order the rows; rows equal in those are ordered
    by their other columns. Of a key with an index only the parts that the rows meet are read.
    """
    rows = _valid(incoming, rules or [])
    for key in keys:
        index = (indexes or {}).get(key)
        held = met_keys(index, stored, rows) if index else _complete(stored, key)
        rows = rows.join(held.select(*key), list(key), "left_anti")
    rows = rows.select(*incoming.columns)
    if len(keys) == 1:
        return _first_per_key(rows, keys[0], arrival)

    rows = materialize(rows, "insert_rows")
    won = materialize(_leading_rows(rows, keys, arrival), "insert_round")
    if won.count() == rows.count():
        return won
    # A row that shares a key with a winner has won itself or lost; rows without a key have won.
    undecided = rows.filter(reduce(lambda a, b: a | b, [_has(key) for key in keys]))
    for key in keys:
        taken = _complete(won, key).select(*key)
        undecided = undecided.join(taken, list(key), "left_anti")
    undecided = undecided.select(*rows.columns)
    return won.unionByName(_first_per_keys(undecided, keys, arrival))


def _valid(rows: DataFrame, rules: list[quality.RowRule]) -> DataFrame:
    for rule in rules:
        rows = rows.filter(~F.coalesce(rule.failed, F.lit(False)))
    return rows


def _has(key: Key) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])


def _complete(rows: DataFrame, key: Key) -> DataFrame:
    """Rows whose key has no null: only those can clash."""
    return rows.filter(_has(key))


def _first_per_key(rows: DataFrame, key: Key, arrival: list[str]) -> DataFrame:
    """The first row of each key value; rows without a key all stay.

    The minimum is taken before the shuffle, so a hot key sends one row per task. Columns of the
    key are alike in all its rows and are not sent a second time, if equal means identical.
    """
    exact = [c for c in key if isinstance(rows.schema[c].dataType, EXACT)]
    ordering = [c for c in (*arrival, *rows.columns) if c not in exact]
    carried = list(dict.fromkeys(ordering)) or exact
    first = (
        _complete(rows, key)
        .groupBy(*key)
        .agg(F.min(F.struct(*carried)).alias("first"))
        .select(*[F.col(f"first.{c}" if c in carried else c).alias(c) for c in rows.columns])
    )
    return rows.filter(~_has(key)).unionByName(first)


def _leading_rows(rows: DataFrame, keys: list[Key], arrival: list[str]) -> DataFrame:
    """The rows that come first under every key they claim; rows without a key all do.

    Under each further key the rows that led so far stand before their equals among all rows,
    so the first row of a key tells by its mark whether it has led.
    """
    ordering = [*arrival, *[c for c in rows.columns if c not in arrival], "behind"]
    found = _first_per_key(rows, keys[0], arrival)
    for key in keys[1:]:
        marked = rows.withColumn("behind", F.lit(True)).unionByName(
            found.withColumn("behind", F.lit(False))
        )
        found = _first_per_key(marked, key, ordering).filter(~F.col("behind")).drop("behind")
    return found


def _numbered(rows: DataFrame, keys: list[Key], arrival: list[str]) -> DataFrame:
    """The rows with ``turn``, a number that grows in arrival order, and ``claims``, how
    many of their keys are complete.

    The ids of a range-sorted DataFrame grow with its order. They are written down, so
    they cannot change. Copies of a row are merged first, lest they all sort into one task.
    """
    others = [c for c in rows.columns if c not in arrival]
    claims = reduce(lambda a, b: a + b, [_has(key).cast("int") for key in keys])
    ordered = rows.dropDuplicates().orderBy(*arrival, *others)
    return materialize(
        ordered.select("*", F.monotonically_increasing_id().alias("turn"), claims.alias("claims")),
        "insert_contested",
    )


def _leading(undecided: DataFrame, keys: list[Key]) -> DataFrame:
    """Turns of the rows that come first under every key they claim."""
    firsts = [
        _complete(undecided, key)
        .groupBy(*key)
        .agg(F.min("turn").alias("turn"), F.min_by("claims", "turn").alias("claims"))
        .select("turn", "claims")
        for key in keys
    ]
    return (
        reduce(DataFrame.unionByName, firsts)
        .groupBy("turn", "claims")
        .agg(F.count("*").alias("won"))
        .filter(F.col("won") == F.col("claims"))
        .select("turn")
    )


def _judged(undecided: DataFrame, keys: list[Key]) -> DataFrame:
    """One round: the rows that come first under all their keys have won, those that clash
    with them have lost, the others stay open."""
    won = _leading(undecided, keys).select("turn", F.lit(True).alias("won"))
    judged = undecided.join(won, "turn", "left")
    winners = undecided.join(won, "turn", "left_semi")
    lost = F.lit(False)
    for number, key in enumerate(keys):
        taken = _complete(winners, key).select(*key, F.lit(True).alias(f"lost_{number}"))
        judged = judged.join(taken, list(key), "left")
        lost = lost | F.coalesce(F.col(f"lost_{number}"), F.lit(False))
    state = F.when(F.col("won"), "won").when(lost, "lost").otherwise("open")
    return materialize(
        judged.select(*undecided.columns, state.alias("state")), "insert_round"
    )


def _clashes(rows: DataFrame, keys: list[Key]) -> DataFrame:
    """Links ``high``, ``low`` from each row to the first one under a key they share."""
    links = []
    for key in keys:
        held = _complete(rows, key)
        first = held.groupBy(*key).agg(F.min("turn").alias("low"))
        links.append(
            held.join(first, list(key))
            .filter(F.col("turn") > F.col("low"))
            .select(F.col("turn").alias("high"), "low")
        )
    return reduce(DataFrame.unionByName, links).distinct()


def _contracted(links: DataFrame) -> DataFrame:
    """The links after a large-star and a small-star step, which keep what is connected.

    First the higher neighbours of a row, then the lower ones and the row itself, are linked
    to the least of them. Only minima are grouped, so a row with many links is no large group.
    """
    both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.min("low").alias("least"))
    least = least.select(F.col("high").alias("low"), F.least("least", "high").alias("least"))
    large = links.join(least, "low").select("high", F.col("least").alias("low")).distinct()
    root = large.groupBy("high").agg(F.min("low").alias("root"))
    lower = (
        large.join(root, "high")
        .filter(F.col("low") > F.col("root"))
        .select(F.col("low").alias("high"), F.col("root").alias("low"))
    )
    return lower.unionByName(root.select("high", F.col("root").alias("low"))).distinct()


def components(rows: DataFrame, keys: list[Key]) -> DataFrame:
    """``turn`` and ``component`` (the least turn) of rows that are linked by shared keys.

    The number of steps grows with the logarithm of the longest chain. Each is written once,
    and what it writes is counted by the same pass.
    """
    links, before = _clashes(rows, keys), None
    while True:
        seen = Observation()
        counts = [F.count("*").alias("links"), F.bit_xor(F.xxhash64("high", "low")).alias("sum")]
        links = materialize(links.observe(seen, *counts), "insert_links")
        if seen.get == before:
            break
        before = seen.get
        links = _contracted(links)
    found = links.select(F.col("high").alias("turn"), F.col("low").alias("component"))
    joined = rows.select("turn").join(found, "turn", "left")
    return joined.select("turn", F.coalesce("component", "turn").alias("component"))


def _one_by_one(members: DataFrame, keys: list[Key]) -> DataFrame:
    """Turns that are accepted when each component's rows are inserted one after the other.

    A component is one row of a task: the fold keeps the keys that are taken so far.
    """
    key_names = [f"key_{number}" for number in range(len(keys))]
    values = [F.when(_has(key), F.struct(*key)).alias(n) for n, key in zip(key_names, keys)]
    entries = members.select("component", F.struct("turn", *values).alias("entry"))
    ordered = entries.groupBy("component").agg(F.array_sort(F.collect_list("entry")).alias("all"))
    types = entries.schema["entry"].dataType
    nothing = F.struct(
        *[F.array().cast(T.ArrayType(types[n].dataType)).alias(n) for n in key_names],
        F.array().cast("array<bigint>").alias("kept"),
    )

    def step(taken: Column, row: Column) -> Column:
        clash = reduce(
            lambda a, b: a | b,
            [
                F.coalesce(F.array_contains(taken[n], row[n]), F.lit(False))
                for n in key_names
            ],
        )
        grown = [
            F.when(row[n].isNull(), taken[n])
            .otherwise(F.concat(taken[n], F.array(row[n])))
            .alias(n)
            for n in key_names
        ]
        kept = F.concat(taken["kept"], F.array(row["turn"])).alias("kept")
        return F.when(clash, taken).otherwise(F.struct(*grown, kept))

    kept = F.aggregate("all", nothing, step, lambda taken: taken["kept"])
    return ordered.select(F.explode(kept).alias("turn"))


def _first_per_keys(
    rows: DataFrame, keys: list[Key], arrival: list[str], most: int = MOST_IN_TASK
) -> DataFrame:
    """The rows a one-by-one insert under several unique keys would keep.

    Rows that share keys, directly or through others, form components. One of at most ``most``
    rows is settled by a task, row after row. The rows of larger ones go through rounds: each
    accepts the rows that come first under all their keys and rejects the rows that clash with
    an accepted one; a row that lost only to a row that was itself rejected stays open. There
    are half as many rounds as the longest chain has rows. All this carries keys and turns only,
    not the rows, and each step is written once.
    """
    numbered = _numbered(rows, keys, arrival)
    if numbered.isEmpty():
        return numbered.select(*rows.columns)
    key_columns = list(dict.fromkeys(c for key in keys for c in key))
    undecided = numbered.select("turn", "claims", *key_columns)
    members = undecided.join(components(undecided, keys), "turn")
    large = members.groupBy("component").count().filter(F.col("count") > most)
    large = materialize(large.select("component"), "insert_large")
    accepted = [_one_by_one(members.join(large, "component", "left_anti"), keys)]
    undecided = members.join(large, "component", "left_semi").drop("component")
    while not undecided.isEmpty():
        judged = _judged(undecided, keys)
        accepted.append(judged.filter(F.col("state") == "won").select("turn"))
        undecided = judged.filter(F.col("state") == "open").drop("state")
    kept = numbered.join(reduce(DataFrame.unionByName, accepted), "turn", "left_semi")
    return kept.select(*rows.columns)


def check_parents(
    table: model.Table, incoming: DataFrame, parents: dict[str, DataFrame]
) -> None:
    """Raise if a row refers to a parent that does not exist; null references pass."""
    for column, (parent, parent_column) in table.references.items():
        if column in incoming.columns and parent in parents:
            orphans = quality.orphan_rows(incoming, column, parents[parent], parent_column)
            if not orphans.isEmpty():
                raise MissingParent(f"{table.name}.{column} has values that are not in {parent}")


def append_or_ignore(
    spark: SparkSession,
    table: model.Table,
    name: str,
    incoming: DataFrame,
    arrival: list[str],
    parents: dict[str, DataFrame] | None = None,
    index_root: str | None = None,
) -> int:
    """Insert-or-ignore into the catalog table ``name`` under the rules of ``table``.

    Returns the number of rows added. A retry after a failed run adds what is missing. With
    ``index_root``, a folder for the indexes of the table's keys, stored keys are read from
    the parts of an index that the incoming rows meet (``key_index``), not from the table.
    """
    if table.primary_key not in incoming.columns:
        raise ValueError(f"rows for {table.name} must bring their {table.primary_key}")
    columns = [c.name for c in table.columns]
    ordering = tuple(c for c in arrival if c not in columns)
    rules = [
        rule
        for rule in quality.row_rules(table, columns)
        if rule.rule in ("not_null", "check", "domain")
    ]
    stored, indexes = spark.table(name), {}
    if index_root:
        indexes = {key: open_index(stored, index_root, key) for key in table.unique_keys}
    with scratch_scope(spark):
        accepted = insert_or_ignore(
            stored,
            with_defaults(incoming, table, keep=ordering),
            table.unique_keys,
            arrival,
            rules,
            indexes,
        ).select(*columns)
        # Written before it is counted and appended, so it does not see its own rows.
        accepted = materialize(accepted, table.name)
        check_parents(table, accepted, parents or {})
        added = accepted.count()
        accepted.write.insertInto(name)
        for index in indexes.values():
            extend_index(index, accepted, spark.table(name))
    return added


def key_of(rows: DataFrame, stored: DataFrame, natural_key: Key, surrogate: str) -> DataFrame:
    """Rows with the surrogate key their natural key has in the stored table.

    No row is lost: one whose natural key is not stored has a null surrogate key.
    """
    return rows.join(stored.select(*natural_key, surrogate), list(natural_key), "left")


def require_keys(rows: DataFrame, natural_key: Key, surrogate: str) -> DataFrame:
    """The rows of ``key_of``, after raising if one of them found no surrogate key."""
    missing = rows.filter(F.col(surrogate).isNull()).select(*natural_key).first()
    if missing:
        raise MissingParent(f"no {surrogate} for {missing.asDict()}")
    return rows
