"""Data quality checks.

A check names the rows that offend. `report` counts them for many checks: all row-level checks of a table
share one aggregation pass; each uniqueness check needs its own grouping.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estratos.functions import blank


class MissingColumns(ValueError):
    """A frame lacks required columns."""


@dataclass(frozen=True)
class RowCheck:
    """A check decided row by row; `fails()` is true on offending rows, and null passes.

    The condition is a function because a Column can only be made in a running session, and suites of
    checks are written down before there is one.
    """

    kind: str
    column: str
    fails: Callable[[], Column]
    severity: str = "warn"


@dataclass(frozen=True)
class UniqueCheck:
    """No key value may occur twice.

    `column` is the name to report. A plain column is checked on itself, and nulls are ignored. A surrogate key is
    checked on the columns it is made of (`keys`), which saves computing the hash and groups narrower rows; it is
    never null, so there nulls are values like others (`null_safe`).
    """

    column: str
    keys: tuple[str, ...]
    severity: str = "warn"
    kind: str = "unique"
    null_safe: bool = False


Check = RowCheck | UniqueCheck


def not_null(column: str, severity: str = "warn") -> RowCheck:
    """DQ1."""
    return RowCheck("not_null", column, lambda: F.col(column).isNull(), severity)


def not_blank(column: str, severity: str = "warn") -> RowCheck:
    """DQ1 for text that cleaning turns from null into ''."""
    return RowCheck("not_blank", column, lambda: blank(column), severity)


def unique(column: str, keys: Sequence[str] | None = None, severity: str = "warn") -> UniqueCheck:
    """DQ2. `keys` are the columns a surrogate key is made of."""
    return UniqueCheck(column, tuple(keys or [column]), severity, null_safe=bool(keys))


def accepted_values(column: str, values: Sequence[object], severity: str = "warn") -> RowCheck:
    """DQ3."""
    return RowCheck("accepted_values", column, lambda: ~F.col(column).isin(list(values)), severity)


def between(column: str, low: float | None = None, high: float | None = None, severity: str = "warn") -> RowCheck:
    """DQ4. Either bound may be left open."""

    def fails() -> Column:
        below = F.col(column) < F.lit(low) if low is not None else F.lit(False)
        above = F.col(column) > F.lit(high) if high is not None else F.lit(False)
        return below | above

    return RowCheck("between", column, fails, severity)


def not_negative(column: str, severity: str = "warn") -> RowCheck:
    """DQ5."""
    return RowCheck("positive_values", column, lambda: F.col(column) < 0, severity)


def agree_within(
    column: str, other: str, tolerance: float, where: Callable[[], Column], severity: str = "warn"
) -> RowCheck:
    """DQ6. Two measures differ by more than a tolerance on rows for which `where()` holds."""

    def fails() -> Column:
        return (F.abs(F.col(column) - F.col(other)) > F.lit(tolerance)) & where()

    return RowCheck(f"agrees_with_{other}", column, fails, severity)


def not_above(column: str, other: str, severity: str = "warn") -> RowCheck:
    """DQ7. A column may not exceed another, such as occupied and available rooms."""
    return RowCheck(f"not_above_{other}", column, lambda: F.col(column) > F.col(other), severity)


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """DQ7. The frame itself, or an error naming the columns it lacks."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    """DQ7. The frame itself, or an error when it is empty; reads at most one row."""
    if df.isEmpty():
        raise ValueError("the table has no rows")
    return df


def _duplicated(df: DataFrame, check: UniqueCheck) -> DataFrame:
    if not check.null_safe:
        df = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in check.keys]))
    return df.groupBy(*check.keys).agg(F.count(F.lit(1)).alias("num_rows")).where(F.col("num_rows") > 1)


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows that offend; for a uniqueness check the repeated keys with their number of rows."""
    if isinstance(check, UniqueCheck):
        return _duplicated(df, check)
    return df.where(check.fails())


def _entry(check: Check, count: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check"),
        F.lit(check.column).alias("column"),
        F.lit(check.severity).alias("severity"),
        F.coalesce(count, F.lit(0)).cast("bigint").alias("n_failed"),
    )


def report(df: DataFrame, checks: Sequence[Check], table: str | None = None) -> DataFrame:
    """Number of offending rows (or repeated keys) per check: check, column, severity, n_failed.

    With `table` a column of that name is put first.
    """
    rows = [c for c in checks if isinstance(c, RowCheck)]
    parts = []
    if rows:
        counts = df.agg(*[F.count_if(c.fails()).alias(f"c{i}") for i, c in enumerate(rows)])
        entries = F.array(*[_entry(c, F.col(f"c{i}")) for i, c in enumerate(rows)])
        parts.append(counts.select(F.inline(entries)))
    for check in checks:
        if isinstance(check, UniqueCheck):
            count = _duplicated(df, check).agg(F.count(F.lit(1)).alias("n"))
            parts.append(count.select(F.inline(F.array(_entry(check, F.col("n"))))))
    out = reduce(DataFrame.unionByName, parts)
    return out.select(F.lit(table).alias("table"), "*") if table else out
