"""Declared rules as validation jobs.

A summary has one row per rule: ``table_name, rule, subject, violations``. Rules on
single rows are counted together in one pass over the table. Uniqueness and
reference rules group by key first, so a hot key is combined before it is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden import model
from linewarden.functions.numbers import count_if


@dataclass(frozen=True)
class RowRule:
    """A rule on single rows; ``failed`` is true for a violation (null counts as passed)."""

    rule: str
    subject: str
    failed: Column


def not_null(column: str) -> RowRule:
    return RowRule("not_null", column, F.col(column).isNull())


def in_domain(column: str, values: tuple[str, ...]) -> RowRule:
    return RowRule("domain", column, ~F.col(column).isin(*values))


def holds(name: str, condition: str) -> RowRule:
    return RowRule("check", name, ~F.expr(condition))


def max_length(column: str, limit: int) -> RowRule:
    return RowRule("length", column, F.char_length(F.col(column)) > limit)


def fits_decimal(column: str, decimal: T.DecimalType) -> RowRule:
    value = F.col(column)
    return RowRule("decimal", column, value.isNotNull() & value.try_cast(decimal).isNull())


def in_lookup(column: str, name: str) -> RowRule:
    """A reference to a lookup table; its few keys are known, so no join is needed."""
    return RowRule("foreign_key", column, ~F.col(column).isin(*model.lookup_keys(name)))


def equals_derived(column: str, expression: Column) -> RowRule:
    return RowRule("derived", column, ~F.col(column).eqNullSafe(expression))


def row_rules(table: model.Table, columns: list[str]) -> list[RowRule]:
    """The declared single-row rules of a table that concern the given columns."""
    present = set(columns)
    decimals = {c.name: c.type for c in table.columns if isinstance(c.type, T.DecimalType)}
    rules = [not_null(c) for c in table.required if c in present]
    rules += [in_domain(c, values) for c, values in table.domains.items() if c in present]
    rules += [holds(name, condition) for name, condition in table.checks.items()]
    rules += [max_length(c, limit) for c, limit in table.lengths.items() if c in present]
    rules += [fits_decimal(c, decimal) for c, decimal in decimals.items() if c in present]
    rules += [equals_derived(c, make()) for c, make in table.derived.items() if c in present]
    return rules


def _summary(
    df: DataFrame, table_name: str, counted: list[tuple[str, str, Column]]
) -> DataFrame:
    """One row per (rule, subject, aggregate of violations)."""
    counts = df.agg(
        *[F.coalesce(total, F.lit(0)).alias(f"rule_{i}") for i, (_, _, total) in enumerate(counted)]
    )
    rows = ", ".join(
        f"'{table_name}', '{rule}', '{subject}', rule_{i}"
        for i, (rule, subject, _) in enumerate(counted)
    )
    names = ("table_name", "rule", "subject", "violations")
    return counts.select(F.expr(f"stack({len(counted)}, {rows})").alias(*names))


def check_rows(df: DataFrame, table_name: str, rules: list[RowRule]) -> DataFrame:
    """Violations of any number of row rules, counted in one pass."""
    return _summary(df, table_name, [(r.rule, r.subject, count_if(r.failed)) for r in rules])


def offending_rows(df: DataFrame, rules: list[RowRule]) -> DataFrame:
    """Rows that break a rule, one output row per broken rule."""
    broken = F.array_compact(
        F.array(
            *[
                F.when(
                    r.failed,
                    F.struct(F.lit(r.rule).alias("rule"), F.lit(r.subject).alias("subject")),
                )
                for r in rules
            ]
        )
    )
    return df.select("*", F.inline(broken))


def check_keys(
    df: DataFrame,
    table_name: str,
    primary_key: str | None = None,
    unique: tuple[tuple[str, ...], ...] = (),
) -> DataFrame:
    """Violations of the primary key and of any number of unique keys, in one pass.

    Counts the key values held by more than one row and, for the primary key, the rows
    without one. A null in a unique key never clashes.
    """
    keys = [(primary_key,)] if primary_key else []
    keys += [key for key in unique if key not in keys]
    columns = list(dict.fromkeys(c for key in keys for c in key))
    groups = df.groupingSets([list(key) for key in keys], *columns).agg(
        F.count("*").alias("held_by"), F.grouping_id().alias("key_set")
    )

    counted = []
    for number, key in enumerate(keys):
        # Bit of a column, first column highest: set when the column is not in the key.
        key_set = sum(2 ** (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in key)
        of_key = F.col("key_set") == key_set
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
        repeated = count_if(of_key & complete & (F.col("held_by") > 1))
        if primary_key and number == 0:
            nulls = F.sum(F.when(of_key & ~complete, F.col("held_by")))
            counted.append(("primary_key_null", primary_key, nulls))
            counted.append(("primary_key_duplicate", primary_key, repeated))
        else:
            counted.append(("unique", ", ".join(key), repeated))
    return _summary(groups, table_name, counted)


def repeated_keys(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Key values held by more than one row, with their row count; a null in a key never clashes."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    return (
        df.filter(complete)
        .groupBy(*key)
        .agg(F.count("*").alias("held_by"))
        .filter(F.col("held_by") > 1)
    )


def repeated_rows(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows that share a unique key with another row."""
    return df.join(repeated_keys(df, key).drop("held_by"), list(key), "left_semi")


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Referenced values without a parent row, with the number of child rows; null passes."""
    referenced = (
        child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("held_by"))
    )
    return referenced.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def check_reference(
    child: DataFrame, table_name: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows whose foreign key has no parent row."""
    orphans = orphan_keys(child, column, parent, parent_column)
    return _summary(orphans, table_name, [("foreign_key", column, F.sum("held_by"))])


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose foreign key has no parent row; null passes."""
    return child.filter(F.col(column).isNotNull()).join(
        parent.select(F.col(parent_column).alias(column)), column, "left_anti"
    )


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def validate(table: model.Table, df: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """Every declared rule of a table that its present columns allow to check.

    One pass for the row rules, one for all keys, one per reference to a growing table.
    """
    present = set(df.columns)
    rules = row_rules(table, df.columns)
    references = {c: parent for c, parent in table.references.items() if c in present}
    rules += [
        in_lookup(c, parent) for c, (parent, _) in references.items() if parent in model.LOOKUPS
    ]
    parts = [check_rows(df, table.name, rules)]

    primary_key = table.primary_key if table.primary_key in present else None
    unique = tuple(key for key in table.unique if set(key) <= present)
    if primary_key or unique:
        parts.append(check_keys(df, table.name, primary_key, unique))
    for column, (parent, parent_column) in references.items():
        if parent not in model.LOOKUPS and parent in parents:
            parts.append(check_reference(df, table.name, column, parents[parent], parent_column))
    return union_all(parts)


def validate_model(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared rule over all given tables."""
    return union_all([validate(model.TABLES[name], df, tables) for name, df in tables.items()])
