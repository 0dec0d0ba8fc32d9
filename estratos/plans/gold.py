"""Facts and dimensions (M9-M18).

`loaded_at` is the run time. It is passed in so that a run can be repeated; without it the column is the
current time, and `loaded_at=None` leaves it out.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estratos import fixed_values as fixed
from estratos.functions import first_of_month, guarded_pct, settled_avg, surrogate_key
from estratos.operators import calendar as cal
from estratos.operators.windows import running_totals
from estratos.plans import silver
from estratos.schemas import GRAIN

NOW = "now"

# Integer domains for which results of one row per year (and quarter) have a proven size.
CALENDAR_YEARS = (1, 9999)
QUARTERS = (1, 4)


def _with_key(df: DataFrame, table: str, alias: str) -> DataFrame:
    """PF16. Put the surrogate key over the table's grain first."""
    return df.select(surrogate_key(*GRAIN[table]).alias(alias), "*")


def _stamped(df: DataFrame, loaded_at: datetime | str | None) -> DataFrame:
    """PF17. Add the audit column."""
    if loaded_at is None:
        return df
    stamp: Column = F.current_timestamp() if loaded_at == NOW else F.lit(loaded_at).cast("timestamp")
    return df.withColumn("loaded_at", stamp)


def int_arrivals_monthly(stg_arrivals: DataFrame) -> DataFrame:
    """M9, AG1. Arrivals summed to the grain of the fact, in one shuffle with partial aggregation."""
    return stg_arrivals.groupBy(*GRAIN["fct_tourism_arrivals"]).agg(
        F.sum("number_of_visitors").alias("total_visitors"),
        F.sum("estimated_spending_usd").alias("total_spending_usd"),
        settled_avg("estimated_spending_usd").alias("average_spending_usd"),
        F.count(F.lit(1)).alias("num_records"),
    )


def arrivals_monthly(raw: DataFrame, min_year: int = fixed.SILVER_ARRIVALS_MIN_YEAR) -> DataFrame:
    """M1 and M9 in one: the same rows as `int_arrivals_monthly(stg_tourism_arrivals(raw))`.

    Cleaning texts is the costly part, and a month of arrivals repeats few texts. So rows are summed by
    their raw texts first, which leaves one row per combination, and only those are cleaned and summed again.
    """
    keys = GRAIN["fct_tourism_arrivals"]
    by_raw_text = silver.typed_arrivals(raw, min_year).groupBy(*keys).agg(
        F.sum("number_of_visitors").alias("visitors"),
        F.sum("estimated_spending_usd").alias("spending"),
        F.count(F.lit(1)).alias("records"),
    )
    spending, records = F.sum("spending"), F.sum("records")
    return silver.clean_arrival_texts(by_raw_text).groupBy(*keys).agg(
        F.sum("visitors").alias("total_visitors"),
        spending.alias("total_spending_usd"),
        (F.round(spending, 6) / records).alias("average_spending_usd"),
        records.alias("num_records"),
    )


def fct_tourism_arrivals(monthly: DataFrame, loaded_at: datetime | str | None = NOW) -> DataFrame:
    """M10."""
    fact = monthly.select(
        "year",
        "month",
        first_of_month("year", "month").alias("period_date"),
        "country_of_origin",
        "destination_department",
        "travel_purpose",
        "entry_point",
        "total_visitors",
        F.round("total_spending_usd", 2).alias("total_spending_usd"),
        F.round("average_spending_usd", 2).alias("average_spending_usd"),
        "num_records",
    )
    return _stamped(_with_key(fact, "fct_tourism_arrivals", "arrival_id"), loaded_at)


def fct_hotel_occupancy(stg: DataFrame, loaded_at: datetime | str | None = NOW) -> DataFrame:
    """M11."""
    fact = stg.select(
        "year",
        "month",
        "period_date",
        "department",
        "occupancy_rate",
        "available_rooms",
        "occupied_rooms",
        F.round("average_rate_cop", 0).alias("average_rate_cop"),
        guarded_pct("occupied_rooms", "available_rooms").alias("calculated_occupancy"),
    )
    return _stamped(_with_key(fact, "fct_hotel_occupancy", "occupancy_id"), loaded_at)


def fct_migration_flows(stg: DataFrame, loaded_at: datetime | str | None = NOW) -> DataFrame:
    """M12."""
    fact = stg.select(
        "year", "month", "period_date", "nationality", "movement_type", "control_point", "number_of_travelers"
    )
    return _stamped(_with_key(fact, "fct_migration_flows", "migration_id"), loaded_at)


def fct_tourism_gdp(stg: DataFrame, loaded_at: datetime | str | None = NOW) -> DataFrame:
    """M13."""
    return _stamped(_with_key(stg, "fct_tourism_gdp", "gdp_id"), loaded_at)


def fct_air_passengers(stg: DataFrame, loaded_at: datetime | str | None = NOW) -> DataFrame:
    """M14."""
    fact = stg.withColumn("pct_international", guarded_pct("international_passengers", "total_passengers"))
    return _stamped(_with_key(fact, "fct_air_passengers", "passenger_id"), loaded_at)


def fct_tourism_balance(stg: DataFrame, loaded_at: datetime | str | None = NOW) -> DataFrame:
    """M15, WF1. With year-to-date income and expenditure."""
    fact = running_totals(
        stg,
        partition="year",
        order="quarter",
        measures={
            "ytd_income": "tourism_income_usd_millions",
            "ytd_expenditure": "tourism_expenditure_usd_millions",
        },
        partition_domain=CALENDAR_YEARS,
        order_domain=QUARTERS,
    ).select(
        "year",
        "quarter",
        "tourism_income_usd_millions",
        "tourism_expenditure_usd_millions",
        "tourism_balance_usd_millions",
        "ytd_income",
        "ytd_expenditure",
        "source",
    )
    return _stamped(_with_key(fact, "fct_tourism_balance", "balance_id"), loaded_at)


def fct_world_bank_comparison(stg: DataFrame, loaded_at: datetime | str | None = NOW) -> DataFrame:
    """M16."""
    fact = stg.select(
        "year", "country_code", "country_name", "indicator_code", "indicator_name", "value", "source"
    )
    return _stamped(_with_key(fact, "fct_world_bank_comparison", "comparison_id"), loaded_at)


def dim_departments(seed: DataFrame, loaded_at: datetime | str | None = NOW) -> DataFrame:
    """M17."""
    return _stamped(seed.select("dane_code", "department", "capital", "region"), loaded_at)


def dim_date(spine: DataFrame, loaded_at: datetime | str | None = NOW) -> DataFrame:
    """M18."""
    return _stamped(cal.calendar(spine), loaded_at)
