"""Integrity rules reported as violating rows instead of enforced on write."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

# Days before and after all others, for periods that are open at an end.
FIRST_DAY, LAST_DAY = "0001-01-01", "9999-12-31"


def audit_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a NULL in a required column, with the names of those columns."""
    missing = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]), lambda c: c.isNotNull()
    )
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return df.filter(any_null).withColumn("null_columns", F.array_join(missing, ","))


def audit_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows; NULL keys are not compared."""
    rows = df.dropna(subset=columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    return rows.filter(F.col("copies") > 1)


def audit_fk(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent."""
    known = parent.select(F.col(parent_column).alias("_known"))
    return child.filter(F.col(column).isNotNull()).join(known, F.col(column) == F.col("_known"), "left_anti")


def audit_length(df: DataFrame, column: str, limit: int) -> DataFrame:
    """Rows whose text is longer than its declared length."""
    return df.filter(F.char_length(column) > limit)


def audit_overlaps(df: DataFrame, keys: list[str], start: str, end: str, tie: str) -> DataFrame:
    """Periods that begin before an earlier one of the same keys has ended, with ``reaches``: the latest such end.

    Both ends belong to a period; a NULL start or end is open. Periods are swept in order of their start, ``tie`` being
    unique within a start: one overlaps where the running maximum of the ends before it is not before its start. Keys
    are cut into cells of a month, whose maxima are carried on, so that a key with very many periods is many tasks.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    begin = F.coalesce(F.col(start).cast("date"), F.lit(FIRST_DAY).cast("date"))
    finish = F.coalesce(F.col(end).cast("date"), F.lit(LAST_DAY).cast("date"))
    rows = df.withColumns({"_begin": begin, "_finish": finish}).withColumn("_cell", F.trunc("_begin", "MM"))
    before = Window.partitionBy(*keys, "_cell").orderBy("_begin", tie).rowsBetween(Window.unboundedPreceding, -1)
    cells = Window.partitionBy(*names).orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_cell").alias("_of"))
        .agg(F.max("_finish").alias("_most"))
        .withColumn("_earlier", F.max("_most").over(cells))
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip([*keys, "_cell"], [*names, "_of"])])
    return (
        rows.withColumn("_within", F.max("_finish").over(before))
        .join(carried, same)
        .withColumn("reaches", F.greatest("_within", "_earlier"))
        .filter(F.col("reaches") >= F.col("_begin"))
        .select(*df.columns, "reaches")
    )


@dataclass(frozen=True)
class Rule:
    """One rule of a table: a condition of a row alone, a key that must be unique, or a reference to a parent's key."""

    name: str
    broken: Column | None = None
    unique: tuple[str, ...] = ()
    column: str | None = None
    parent: DataFrame | None = None
    parent_column: str | None = None


def not_null(column: str) -> Rule:
    return Rule(f"{column} is null", broken=F.col(column).isNull())


def at_most(column: str, limit: int) -> Rule:
    return Rule(f"{column} is longer than {limit}", broken=F.char_length(column) > limit)


def holds(name: str, condition: Column) -> Rule:
    """Any condition of one row; unknown counts as held, as in a CHECK."""
    return Rule(name, broken=~condition)


def unique(*columns: str) -> Rule:
    return Rule(f"{', '.join(columns)} is not unique", unique=columns)


def references(column: str, parent: DataFrame, parent_column: str) -> Rule:
    return Rule(f"{column} has no parent", column=column, parent=parent, parent_column=parent_column)


def audit_rules(df: DataFrame, rules: Sequence[Rule], counts: Observation | None = None) -> DataFrame:
    """Rows that break any rule, with ``violations``, the names of those rules in their order; one scan for all.

    ``counts``, filled when the result is read, has the rows that break each rule and all ``rows``. Conditions cost
    nothing but the scan. References are joined first and uniqueness is counted after them, so a key that is both
    shares one shuffle. As in a table's constraints, NULL keys are neither compared nor looked up; they are spread
    over the tasks. The rows of one repeated key meet in one task, which spills them; ``audit_unique`` sums map-side
    where a key may be repeated without measure.
    """
    rows, broken = df, {}
    for i, rule in enumerate(rules):
        if rule.broken is not None:
            broken[rule.name] = F.coalesce(rule.broken, F.lit(False))
        elif rule.parent is not None:
            known = rule.parent.select(F.col(rule.parent_column).alias(f"_known{i}")).filter(F.col(f"_known{i}").isNotNull()).distinct()
            rows = rows.join(known, F.col(rule.column) == F.col(f"_known{i}"), "left")
            broken[rule.name] = F.col(rule.column).isNotNull() & F.col(f"_known{i}").isNull()
    for i, rule in enumerate(rules):
        if rule.unique:
            whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule.unique])
            spread = F.when(~whole, F.monotonically_increasing_id())
            apart = [] if len(rule.unique) == 1 and not df.schema[rule.unique[0]].nullable else [f"_apart{i}"]
            rows = rows.withColumn(f"_apart{i}", spread)
            rows = rows.withColumn(f"_copies{i}", F.count(F.lit(1)).over(Window.partitionBy(*rule.unique, *apart)))
            broken[rule.name] = whole & (F.col(f"_copies{i}") > 1)
    flags = {f"_broken{i}": broken[rule.name] for i, rule in enumerate(rules)}
    rows = rows.withColumns(flags)
    if counts is not None:
        rows = rows.observe(
            counts, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f)).alias(r.name) for f, r in zip(flags, rules)]
        )
    names = F.array_compact(F.array(*[F.when(F.col(f), F.lit(r.name)) for f, r in zip(flags, rules)]))
    return rows.withColumn("violations", names).filter(F.size("violations") > 0).select(*df.columns, "violations")
