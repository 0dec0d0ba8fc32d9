"""Sorting and limiting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top(df: DataFrame, n: int, measure: str, *tie_break: str) -> DataFrame:
    """SL1, SL2. The n rows with the largest measure; ties in the order of the tie-break columns.

    Planned as a top-k per task followed by a merge, without a full sort.
    """
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]).limit(n)


def ordered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SL3. Sort by several keys, nulls last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in keys])


def preview(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """SL4. The first n rows in key order, each with the number of all rows."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return ordered(df, keys).limit(n).withColumn("total_rows", total)
