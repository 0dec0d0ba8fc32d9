"""Group-by operators.

All of them are built on functions with a partial step, so that rows meet in the map tasks first and a key
that holds a large share of the rows reaches its reduce task as a handful of partial rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total_by(df: DataFrame, keys: Sequence[str], **measures: str | Column) -> DataFrame:
    """AG4, AG5, AG7, AG10, AG14. Sums by keys: `total_by(df, ["year"], total="visitors")`.

    A measure is the name of a column to sum, or an aggregate expression of its own.
    """
    return df.groupBy(*keys).agg(
        *[(F.sum(m) if isinstance(m, str) else m).alias(name) for name, m in measures.items()]
    )


def ranked_totals(df: DataFrame, key: str, measure: str, alias: str) -> DataFrame:
    """AG6. Sum per category, largest first; equal totals in key order."""
    return total_by(df, [key], **{alias: measure}).orderBy(F.col(alias).desc(), F.col(key).asc_nulls_last())


def totals_with_distincts(
    df: DataFrame, sums: Mapping[str, str], distincts: Mapping[str, str]
) -> DataFrame:
    """AG2, AG3. One row of sums and exact distinct counts.

    A single aggregation with several distinct counts would emit every row once per count. Here the rows
    are first reduced to the combinations of the counted columns, and only those are counted.
    """
    combinations = df.groupBy(*distincts.values()).agg(
        *[F.sum(source).alias(name) for name, source in sums.items()]
    )
    return combinations.agg(
        *[F.sum(name).alias(name) for name in sums],
        *[F.count_distinct(F.col(source)).alias(name) for name, source in distincts.items()],
    )


def totals_with_approx_distincts(
    df: DataFrame, sums: Mapping[str, str], distincts: Mapping[str, str], rsd: float = 0.02
) -> DataFrame:
    """As `totals_with_distincts` in one step with bounded state, distinct counts approximate."""
    return df.agg(
        *[F.sum(source).alias(name) for name, source in sums.items()],
        *[F.approx_count_distinct(source, rsd).alias(name) for name, source in distincts.items()],
    )


def sums_by_category(
    df: DataFrame, keys: Sequence[str], category: str, measure: str, columns: Mapping[str, str]
) -> DataFrame:
    """AG11. One column of sums per listed category value, 0 where a group has none."""
    return df.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col(category) == F.lit(value), F.col(measure)).otherwise(F.lit(0))).alias(name)
            for name, value in columns.items()
        ]
    )


def pivot_max(
    df: DataFrame, keys: Sequence[str], category: str, columns: Mapping[str, tuple[str, Column]]
) -> DataFrame:
    """AG12. One column per listed category value holding the largest value of an expression."""
    return df.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(category) == F.lit(value), expression)).alias(name)
            for name, (value, expression) in columns.items()
        ]
    )


def load_metrics(
    df: DataFrame,
    year: str = "year",
    distinct: Mapping[str, str] | None = None,
    approximate: bool = False,
) -> DataFrame:
    """AG15, IO21. Rows, first and last year, number of distinct values of chosen columns.

    One pass: rows are first reduced to the combinations of the counted columns, and only those are counted.
    """
    aggs = [F.count(F.lit(1)).alias("num_rows"), F.min(year).alias("year_min"), F.max(year).alias("year_max")]
    distinct = distinct or {}
    if approximate:
        return df.agg(*aggs, *[F.approx_count_distinct(c).alias(n) for n, c in distinct.items()])
    if not distinct:
        return df.agg(*aggs)
    combinations = df.groupBy(*dict.fromkeys(distinct.values())).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(year).alias("_first"), F.max(year).alias("_last")
    )
    return combinations.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("num_rows"), F.min("_first").alias("year_min"),
        F.max("_last").alias("year_max"), *[F.count_distinct(F.col(c)).alias(n) for n, c in distinct.items()],
    )
