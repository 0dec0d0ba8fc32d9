"""The questions of the second dashboard (E1-E7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estratos.functions import exact_avg, exact_sum
from estratos.operators import topk
from estratos.operators.filters import sorted_distinct
from estratos.plans import reports


def department_list(fct_arrivals: DataFrame) -> DataFrame:
    """E1."""
    return sorted_distinct(fct_arrivals, "destination_department", "department")


def department_arrivals(fct_arrivals: DataFrame, department: str) -> DataFrame:
    """E2, AG14."""
    rows = fct_arrivals.where(F.col("destination_department") == F.lit(department))
    monthly = rows.groupBy("year", "month").agg(
        F.sum("total_visitors").alias("total_visitors"),
        F.round(exact_sum("total_spending_usd", 2), 0).alias("total_spending_usd"),
    )
    return topk.ordered(monthly, ["year", "month"])


def department_occupancy(fct_occupancy: DataFrame, department: str) -> DataFrame:
    """E3."""
    rows = fct_occupancy.where(F.col("department") == F.lit(department))
    return topk.ordered(
        rows.select("year", "month", "occupancy_rate", "average_rate_cop"), ["year", "month"]
    )


def arrivals_by_year(fct_arrivals: DataFrame) -> DataFrame:
    """E4."""
    return reports.arrivals_by_year(fct_arrivals)


def top_countries(fct_arrivals: DataFrame) -> DataFrame:
    """E5."""
    return reports.top_countries(fct_arrivals, spending="average_spending_usd")


def occupancy_trend(fct_occupancy: DataFrame) -> DataFrame:
    """E6."""
    return topk.ordered(
        fct_occupancy.select("year", "month", "department", "occupancy_rate"), ["year", "month", "department"]
    )


def seasonality(fct_arrivals: DataFrame) -> DataFrame:
    """E7, AG5."""
    monthly = fct_arrivals.groupBy("month").agg(
        F.sum("total_visitors").alias("total_visitors"),
        F.round(exact_avg("average_spending_usd", 2), 2).alias("average_spending"),
    )
    return monthly.orderBy("month")
