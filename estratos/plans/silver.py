"""Cleaned tables (M1-M8): validity filter on raw columns, then typed and trimmed projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estratos import fixed_values as fixed
from estratos.functions import clamp, first_of_month, rounded_int, title_case, trim_spaces
from estratos.operators.filters import valid_rows


def _int(df: DataFrame, name: str, kind: str = "int") -> Column:
    """Integer of a column; only fractional or text input needs rounding."""
    whole = isinstance(df.schema[name].dataType, T.IntegralType)
    return F.col(name).cast(kind) if whole else rounded_int(name, kind)


def _count(df: DataFrame, name: str) -> Column:
    """A 64-bit count, 0 where it is missing."""
    return F.coalesce(_int(df, name, "bigint"), F.lit(0))


def _double(name: str, default: float = 0.0) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(default))


def _source(default: str) -> Column:
    return F.coalesce(trim_spaces("source"), F.lit(default))


def _year(minimum: int) -> Column:
    return F.col("year") >= minimum


ARRIVAL_TEXTS = ("country_of_origin", "destination_department", "travel_purpose", "entry_point")


def typed_arrivals(raw: DataFrame, min_year: int = fixed.SILVER_ARRIVALS_MIN_YEAR) -> DataFrame:
    """M1 without the cleaning of texts: valid rows, typed, texts as they came."""
    valid = valid_rows(raw, F.col("number_of_visitors") >= 0, _year(min_year), F.col("month").between(1, 12))
    return valid.select(
        F.col("arrival_date").cast("date").alias("arrival_date"),
        _int(raw, "year").alias("year"),
        _int(raw, "month").alias("month"),
        *ARRIVAL_TEXTS,
        _count(raw, "number_of_visitors").alias("number_of_visitors"),
        _double("estimated_spending_usd").alias("estimated_spending_usd"),
    )


def clean_arrival_texts(df: DataFrame) -> DataFrame:
    """PF10. Title case of the arrivals' four texts."""
    return df.withColumns({name: title_case(name) for name in ARRIVAL_TEXTS})


def stg_tourism_arrivals(raw: DataFrame, min_year: int = fixed.SILVER_ARRIVALS_MIN_YEAR) -> DataFrame:
    """M1."""
    return clean_arrival_texts(typed_arrivals(raw, min_year))


def stg_hotel_occupancy(
    raw: DataFrame, min_year: int = fixed.SILVER_OCCUPANCY_MIN_YEAR, preserve_null: bool = False
) -> DataFrame:
    """M2. A missing rate becomes 0 unless `preserve_null`."""
    valid = valid_rows(raw, _year(min_year), F.col("month").between(1, 12))
    return valid.select(
        _int(raw, "year").alias("year"),
        _int(raw, "month").alias("month"),
        first_of_month(_int(raw, "year"), _int(raw, "month")).alias("period_date"),
        title_case("department").alias("department"),
        clamp(F.col("occupancy_rate").cast("double"), 0, 100, preserve_null).alias("occupancy_rate"),
        _count(raw, "available_rooms").alias("available_rooms"),
        _count(raw, "occupied_rooms").alias("occupied_rooms"),
        _double("average_rate_cop").alias("average_rate_cop"),
    )


def stg_migracion_flows(raw: DataFrame, min_year: int = fixed.SILVER_MIGRATION_MIN_YEAR) -> DataFrame:
    """M3."""
    valid = valid_rows(
        raw, _year(min_year), F.col("month").between(1, 12), F.col("number_of_travelers") > 0
    )
    return valid.select(
        _int(raw, "year").alias("year"),
        _int(raw, "month").alias("month"),
        first_of_month(_int(raw, "year"), _int(raw, "month")).alias("period_date"),
        trim_spaces("nationality").alias("nationality"),
        F.lower(trim_spaces("movement_type")).alias("movement_type"),
        trim_spaces("control_point").alias("control_point"),
        _count(raw, "number_of_travelers").alias("number_of_travelers"),
        _source(fixed.SOURCE_MIGRATION).alias("source"),
    )


def stg_dane_tourism_gdp(raw: DataFrame, min_year: int = fixed.SILVER_GDP_MIN_YEAR) -> DataFrame:
    """M4."""
    valid = valid_rows(raw, _year(min_year), F.col("tourism_gdp_billions_cop") > 0)
    return valid.select(
        _int(raw, "year").alias("year"),
        _double("tourism_gdp_billions_cop").alias("tourism_gdp_billions_cop"),
        _double("pct_of_total_gdp").alias("pct_of_total_gdp"),
        _count(raw, "tourism_employment_thousands").alias("tourism_employment_thousands"),
        _double("annual_variation_pct").alias("annual_variation_pct"),
        _source(fixed.SOURCE_GDP).alias("source"),
    )


def stg_aerocivil_passengers(raw: DataFrame, min_year: int = fixed.SILVER_AIR_MIN_YEAR) -> DataFrame:
    """M5."""
    valid = valid_rows(raw, _year(min_year), F.col("month").between(1, 12), F.col("total_passengers") > 0)
    return valid.select(
        _int(raw, "year").alias("year"),
        _int(raw, "month").alias("month"),
        first_of_month(_int(raw, "year"), _int(raw, "month")).alias("period_date"),
        trim_spaces("airport").alias("airport"),
        trim_spaces("airport_city").alias("airport_city"),
        _count(raw, "domestic_passengers").alias("domestic_passengers"),
        _count(raw, "international_passengers").alias("international_passengers"),
        _count(raw, "total_passengers").alias("total_passengers"),
    )


def stg_banrep_tourism_balance(raw: DataFrame, min_year: int = fixed.SILVER_BALANCE_MIN_YEAR) -> DataFrame:
    """M6."""
    valid = valid_rows(raw, _year(min_year), F.col("quarter").between(1, 4))
    return valid.select(
        _int(raw, "year").alias("year"),
        _int(raw, "quarter").alias("quarter"),
        _double("tourism_income_usd_millions").alias("tourism_income_usd_millions"),
        _double("tourism_expenditure_usd_millions").alias("tourism_expenditure_usd_millions"),
        _double("tourism_balance_usd_millions").alias("tourism_balance_usd_millions"),
        _source(fixed.SOURCE_BALANCE).alias("source"),
    )


def _valid_indicators(raw: DataFrame, min_year: int) -> DataFrame:
    return valid_rows(raw, _year(min_year), F.col("value") > 0)


def stg_world_bank_arrivals(raw: DataFrame, min_year: int = fixed.SILVER_INDICATOR_MIN_YEAR) -> DataFrame:
    """M7."""
    return _valid_indicators(raw, min_year).select(
        _int(raw, "year").alias("year"),
        trim_spaces("indicator_code").alias("indicator_code"),
        trim_spaces("indicator_name").alias("indicator_name"),
        _double("value").alias("value"),
        trim_spaces("country_code").alias("country_code"),
        _source(fixed.SOURCE_INDICATORS).alias("source"),
    )


def stg_world_bank_regional(raw: DataFrame, min_year: int = fixed.SILVER_INDICATOR_MIN_YEAR) -> DataFrame:
    """M8."""
    return _valid_indicators(raw, min_year).select(
        _int(raw, "year").alias("year"),
        trim_spaces("country_code").alias("country_code"),
        trim_spaces("country_name").alias("country_name"),
        trim_spaces("indicator_code").alias("indicator_code"),
        trim_spaces("indicator_name").alias("indicator_name"),
        _double("value").alias("value"),
        _source(fixed.SOURCE_INDICATORS).alias("source"),
    )
