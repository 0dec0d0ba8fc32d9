"""Generated calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estratos.fixed_values import CALENDAR_END, CALENDAR_START
from estratos.functions import day_name, first_of_month, month_name, season_quarter


def days_between(bounds: DataFrame, start: Column | str, end: Column | str) -> DataFrame:
    """GR1. One row per day from start to end, both included, for a one-row frame of bounds."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    days = F.sequence(start.cast("date"), end.cast("date"), F.expr("interval 1 day"))
    day = F.col("date_day")
    return bounds.select(F.explode(days).alias("date_day")).select(
        "date_day",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        (F.dayofweek(day) - 1).alias("day_of_week"),
        season_quarter(F.month(day)).alias("quarter"),
    )


def date_spine(spark: SparkSession, start: str | date = CALENDAR_START, end: str | date = CALENDAR_END) -> DataFrame:
    """GR1. The spine between two given days."""
    return days_between(spark.range(1), F.lit(str(start)), F.lit(str(end)))


def calendar(spine: DataFrame) -> DataFrame:
    """GR2. Add month start, Spanish day and month names and the weekend flag to a spine."""
    return spine.select(
        "date_day", "year", "month", "day", "day_of_week", "quarter",
        first_of_month("year", "month").alias("period_date"),
        day_name("day_of_week").alias("day_name"),
        month_name("month").alias("month_name"),
        F.col("day_of_week").isin(0, 6).alias("is_weekend"),
    )


def month_starts(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """One row per month from the month of start to the month of end."""
    months = F.sequence(
        F.trunc(F.col(start).cast("date"), "month"),
        F.trunc(F.col(end).cast("date"), "month"),
        F.expr("interval 1 month"),
    )
    return bounds.select(F.explode(months).alias("period_date"))


def months_spanned(start: str | date, end: str | date) -> int:
    """Number of calendar months touched by two given days; a bound for joins on the month."""
    first, last = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    return (last.year - first.year) * 12 + last.month - first.month + 1
