"""The data checks of each cleaned and gold table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estratos import fixed_values as fixed
from estratos.operators import quality as q
from estratos.operators.quality import Check
from estratos.schemas import GRAIN

# Which checks hold on which columns.
_MONTHS = list(range(1, 13))
_QUARTERS = [1, 2, 3, 4]
_SEASONS = ["Q1", "Q2", "Q3", "Q4"]
_MOVEMENTS = [fixed.MOVEMENT_IN, fixed.MOVEMENT_OUT]


def _not_null(*columns: str) -> list[Check]:
    return [q.not_null(c) for c in columns]


def _key(table: str, column: str) -> list[Check]:
    return [q.unique(column, GRAIN[table]), q.not_null(column)]


SILVER: dict[str, list[Check]] = {
    "stg_tourism_arrivals": [
        *_not_null("arrival_date", "year", "country_of_origin", "destination_department", "number_of_visitors"),
        q.between("number_of_visitors", 0, 100000),
    ],
    "stg_hotel_occupancy": [
        *_not_null("department", "occupancy_rate", "year", "month"),
        q.between("occupancy_rate", 0, 100),
        q.accepted_values("month", _MONTHS),
    ],
    "stg_world_bank_arrivals": [
        *_not_null("year", "indicator_code", "value", "source"),
        q.accepted_values("indicator_code", list(fixed.INDICATORS)),
        q.between("value", 0),
    ],
    "stg_dane_tourism_gdp": [
        *_not_null("year", "tourism_gdp_billions_cop", "pct_of_total_gdp"),
        q.between("tourism_gdp_billions_cop", 0),
        q.between("pct_of_total_gdp", 0, 100),
    ],
    "stg_migracion_flows": [
        *_not_null("year", "month", "nationality", "movement_type", "number_of_travelers"),
        q.accepted_values("month", _MONTHS),
        q.accepted_values("movement_type", _MOVEMENTS),
        q.between("number_of_travelers", 0),
    ],
    "stg_world_bank_regional": [
        *_not_null("year", "country_code", "indicator_code", "value"),
        q.accepted_values("indicator_code", fixed.REGIONAL_INDICATORS),
        q.between("value", 0),
    ],
    "stg_aerocivil_passengers": [
        *_not_null("year", "month", "airport", "total_passengers"),
        q.accepted_values("month", _MONTHS),
        q.between("total_passengers", 0),
    ],
    "stg_banrep_tourism_balance": [
        *_not_null("year", "quarter", "tourism_income_usd_millions", "tourism_expenditure_usd_millions"),
        q.accepted_values("quarter", _QUARTERS),
        q.between("tourism_income_usd_millions", 0),
        q.between("tourism_expenditure_usd_millions", 0),
    ],
}

OCCUPANCY_TOLERANCE = 10.0


def occupancy_agrees() -> Check:
    """DQ6. Reported and calculated occupancy within ten points where there are rooms."""
    return q.agree_within(
        "occupancy_rate", "calculated_occupancy", OCCUPANCY_TOLERANCE, lambda: F.col("available_rooms") > 0
    )


GOLD: dict[str, list[Check]] = {
    "fct_tourism_arrivals": [
        *_key("fct_tourism_arrivals", "arrival_id"),
        *_not_null("year", "total_visitors"),
        q.between("total_visitors", 0),
    ],
    "fct_hotel_occupancy": [
        *_key("fct_hotel_occupancy", "occupancy_id"),
        q.between("occupancy_rate", 0, 100),
        occupancy_agrees(),
    ],
    "dim_departments": [
        q.unique("dane_code"),
        q.not_null("dane_code"),
        q.unique("department"),
        q.not_null("department"),
    ],
    "dim_date": [
        q.unique("date_day"),
        *_not_null("date_day", "year", "month", "quarter"),
        q.between("year", int(fixed.CALENDAR_START[:4]), int(fixed.CALENDAR_END[:4])),
        q.between("month", 1, 12),
        q.accepted_values("quarter", _SEASONS),
    ],
    "fct_tourism_gdp": [
        *_key("fct_tourism_gdp", "gdp_id"),
        *_not_null("year", "tourism_gdp_billions_cop"),
        q.between("tourism_gdp_billions_cop", 0),
    ],
    "fct_migration_flows": [
        *_key("fct_migration_flows", "migration_id"),
        *_not_null("nationality", "movement_type", "number_of_travelers"),
        q.accepted_values("movement_type", _MOVEMENTS),
        q.between("number_of_travelers", 0),
    ],
    "fct_world_bank_comparison": [
        *_key("fct_world_bank_comparison", "comparison_id"),
        *_not_null("country_code", "indicator_code", "value"),
        q.between("value", 0),
    ],
    "fct_air_passengers": [
        *_key("fct_air_passengers", "passenger_id"),
        *_not_null("airport", "total_passengers"),
        q.between("total_passengers", 0),
    ],
    "fct_tourism_balance": [
        *_key("fct_tourism_balance", "balance_id"),
        *_not_null("year", "quarter", "tourism_income_usd_millions"),
        q.accepted_values("quarter", _QUARTERS),
        q.between("tourism_income_usd_millions", 0),
    ],
}


def quality_report(tables: Mapping[str, DataFrame], suites: Mapping[str, Sequence[Check]]) -> DataFrame:
    """The reports of several tables, one below the other: table, check, column, severity, n_failed."""
    parts = [q.report(df, suites[name], name) for name, df in tables.items() if suites.get(name)]
    return reduce(DataFrame.unionByName, parts)
