"""Declarative data checks.

A suite is a list of checks.  All row checks of a table are one aggregate over one scan,
all uniqueness checks are one grouped count over a second, and each reference check is an
anti join of its distinct values.
Result rows: table, check, column, severity, failed_rows, passed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.aggregates import duplicated
from tillroll.operators.joins import orphans

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Check:
    name: str
    column: str
    severity: str = ERROR
    failing: Column | None = None          # row check: rows for which this is true fail
    at_least: int | None = None            # row count check
    unique: tuple[str, ...] = ()           # uniqueness check
    only: Column | None = None             # uniqueness among these rows
    parent: DataFrame | None = None        # reference check
    field: str = ""


def row_count(at_least: int = 1) -> Check:
    return Check("row_count", "", at_least=at_least)


def not_null(col: str, severity: str = ERROR) -> Check:
    return Check("not_null", col, severity, failing=F.col(col).isNull())


def unique(col: str, severity: str = ERROR) -> Check:
    """NULLs are left out."""
    return Check("unique", col, severity, unique=(col,))


def unique_combo(cols: Sequence[str], severity: str = ERROR) -> Check:
    return Check("unique_combo", ",".join(cols), severity, unique=tuple(cols))


def one_current(key: str, severity: str = ERROR) -> Check:
    return Check("one_current", key, severity, unique=(key,), only=F.col("_is_current"))


def between(col: str, low=None, high=None, severity: str = ERROR) -> Check:
    """Limits are included; NULLs pass."""
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(col) < low)
    if high is not None:
        outside = outside | (F.col(col) > high)
    return Check("between", col, severity, failing=outside)


def in_set(col: str, values: Sequence, severity: str = ERROR) -> Check:
    """NULLs pass."""
    return Check("in_set", col, severity, failing=~F.col(col).isin(*values))


def length_equals(col: str, n: int, severity: str = ERROR) -> Check:
    """NULLs pass."""
    return Check("length_equals", col, severity, failing=F.length(col) != n)


def expression(name: str, col: str, holds: Column | str, severity: str = ERROR) -> Check:
    """``holds`` must be true in every row; an unknown (NULL) outcome fails."""
    test = F.expr(holds) if isinstance(holds, str) else holds
    return Check(name, col, severity, failing=~F.coalesce(test, F.lit(False)))


def relationships(col: str, parent: DataFrame, field: str, severity: str = ERROR) -> Check:
    """NULLs pass."""
    return Check("relationships", col, severity, parent=parent, field=field)


def _line(table: str, check: Check, failed: Column) -> Column:
    failed = F.coalesce(failed, F.lit(0)).cast("bigint")
    return F.struct(
        F.lit(table).alias("table"), F.lit(check.name).alias("check"),
        F.lit(check.column).alias("column"), F.lit(check.severity).alias("severity"),
        failed.alias("failed_rows"), (failed == 0).alias("passed"),
    )


def _one_pass(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    counts = [F.count("*").alias("_rows")] + [
        F.count_if(c.failing).alias(f"_f{i}") for i, c in enumerate(checks) if c.failing is not None
    ]
    lines = [
        _line(table, c, F.col(f"_f{i}") if c.failing is not None
              else F.greatest(F.lit(c.at_least) - F.col("_rows"), F.lit(0)))
        for i, c in enumerate(checks)
    ]
    return df.agg(*counts).select(F.inline(F.array(*lines)))


def _uniqueness(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """All uniqueness checks of a table in one scan: rows that share a key, per check.

    Every row gives one (check, key) pair per check; counting combines on the map side,
    so a value that fills a large part of the table travels as one row per task.
    """
    keys = []
    for i, c in enumerate(checks):
        present = reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in c.unique])
        wanted = present if c.only is None else present & c.only
        text = F.col(c.unique[0]).cast("string") if len(c.unique) == 1 else F.to_json(
            F.struct(*c.unique))
        keys.append(F.struct(F.lit(i).alias("_check"), F.when(wanted, text).alias("_key")))
    pairs = df.select(F.inline(F.array(*keys))).filter(F.col("_key").isNotNull())
    repeated = duplicated(pairs, ("_check", "_key"))
    totals = repeated.agg(
        *[F.sum(F.when(F.col("_check") == i, F.col("n"))).alias(f"_f{i}") for i in range(len(checks))])
    return totals.select(
        F.inline(F.array(*[_line(table, c, F.col(f"_f{i}")) for i, c in enumerate(checks)])))


def _reference(df: DataFrame, table: str, check: Check) -> DataFrame:
    broken = orphans(df, check.column, check.parent, check.field)
    return broken.agg(F.sum("rows").alias("_failed")).select(
        F.inline(F.array(_line(table, check, F.col("_failed"))))
    )


def run_suite(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    plain = [c for c in checks if c.failing is not None or c.at_least is not None]
    parts = [_one_pass(df, table, plain)] if plain else []
    distinct = [c for c in checks if c.unique]
    parts += [_uniqueness(df, table, distinct)] if distinct else []
    parts += [_reference(df, table, c) for c in checks if c.parent is not None]
    return reduce(DataFrame.unionByName, parts)


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows that break a check, for storing beside the results; a row count has none."""
    if check.unique:
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in check.unique])
        wanted = df.filter(present if check.only is None else present & check.only)
        repeated = wanted.groupBy(*check.unique).agg(F.count("*").alias("_rows")).filter("_rows > 1")
        return wanted.join(repeated, list(check.unique), "left_semi").select(*df.columns)
    if check.parent is not None:
        known = check.parent.select(F.col(check.field).alias("_known"))
        return df.filter(F.col(check.column).isNotNull()).join(
            known, F.col(check.column) == F.col("_known"), "left_anti")
    return df.filter(F.lit(False) if check.failing is None else check.failing)


def failures(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame | None:
    """(table, check, column, row) of every row that breaks one of ``checks``, as JSON text."""
    parts = [
        failing_rows(df, c).select(
            F.lit(table).alias("table"), F.lit(c.name).alias("check"), F.lit(c.column).alias("column"),
            F.to_json(F.struct(*df.columns)).alias("row"))
        for c in checks
    ]
    return reduce(DataFrame.unionByName, parts) if parts else None


def verdict(results: DataFrame) -> DataFrame:
    """One row: does the run pass?  Warnings do not fail it."""
    return results.agg(
        F.count("*").alias("checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.bool_and(F.col("passed") | (F.col("severity") == WARN)).alias("passed"),
    )
