"""Simple statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def least_squares_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """ST-R1. Ordinary least squares of y on x, one row; pairs with a null are left out.

    All statistics have partial forms and come from the same pass.
    """
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("num_points"),
    )


def with_fitted(df: DataFrame, x: str, y: str, alias: str = "fitted") -> DataFrame:
    """ST-R1. Add the value of the fitted line at x to every row, for results of a few rows such as one per year.

    The line is a window over all rows, so the result is computed once; rows that do not fit one task belong in
    `least_squares_line` and a join.
    """
    everything = Window.partitionBy()
    return df.withColumn(alias, F.regr_intercept(y, x).over(everything) + F.regr_slope(y, x).over(everything) * F.col(x))
