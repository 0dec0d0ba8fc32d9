"""Row filters and value lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estratos.fixed_values import NO_FILTER


def in_years(df: DataFrame, years: tuple[int, int] | None, column: str = "year") -> DataFrame:
    """PF13. Keep years between two bounds, both included; None keeps everything."""
    if years is None:
        return df
    low, high = years
    return df.where(F.col(column).between(F.lit(int(low)), F.lit(int(high))))


def equal_unless_all(df: DataFrame, column: str, choice: str | None) -> DataFrame:
    """PF13. Keep rows equal to a chosen value; None or the 'all' choice keeps everything."""
    if choice is None or choice == NO_FILTER:
        return df
    return df.where(F.col(column) == F.lit(choice))


def valid_rows(df: DataFrame, *conditions: Column) -> DataFrame:
    """PF11/PF12. Keep rows for which all conditions are true; null counts as false.

    Conditions are written on the raw columns, so that they reach the file scan as pushed filters.
    """
    for condition in conditions:
        df = df.where(condition)
    return df


def sorted_distinct(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """PF14. The distinct values of a column in order, nulls last."""
    name = alias or column
    return df.select(F.col(column).alias(name)).distinct().orderBy(F.col(name).asc_nulls_last())
