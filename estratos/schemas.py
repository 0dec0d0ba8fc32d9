"""Canonical tables: one explicit schema and one declared grain each.

Periods are 32-bit integers. Counts are 64-bit: a month of a large table passes two thousand million.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema of 'name type, ...'. Spark's own parser of such texts needs a running session."""
    pairs = [part.split() for part in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BRONZE = {
    "arrivals": _schema(
        "arrival_date date, year int, month int, country_of_origin string, destination_department string, "
        "travel_purpose string, entry_point string, number_of_visitors bigint, estimated_spending_usd double"
    ),
    "occupancy": _schema(
        "year int, month int, department string, occupancy_rate double, available_rooms bigint, "
        "occupied_rooms bigint, average_rate_cop double"
    ),
    "gdp": _schema(
        "year int, tourism_gdp_billions_cop double, pct_of_total_gdp double, "
        "tourism_employment_thousands bigint, annual_variation_pct double, source string"
    ),
    "migration": _schema(
        "year int, month int, nationality string, movement_type string, control_point string, "
        "number_of_travelers bigint, source string"
    ),
    "air": _schema(
        "year int, month int, airport string, airport_city string, domestic_passengers bigint, "
        "international_passengers bigint, total_passengers bigint"
    ),
    "balance": _schema(
        "year int, quarter int, tourism_income_usd_millions double, tourism_expenditure_usd_millions double, "
        "tourism_balance_usd_millions double, source string"
    ),
    "indicators": _schema(
        "year int, indicator_code string, indicator_name string, value double, country_code string, "
        "country_name string, source string"
    ),
    "regional": _schema(
        "year int, country_code string, country_name string, indicator_code string, indicator_name string, "
        "value double, source string"
    ),
}

DEPARTMENT_SEED = _schema("dane_code string, department string, capital string, region string")

# One page of the indicator service: `[metadata, [record, ...]]`; only the second element is typed.
_NAMED = _schema("id string, value string")
INDICATOR_RECORDS = T.ArrayType(
    T.StructType(
        [
            T.StructField("indicator", _NAMED),
            T.StructField("country", _NAMED),
            T.StructField("date", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
)

# Grain of each gold table: the columns its surrogate key is made of.
GRAIN = {
    "fct_tourism_arrivals": [
        "year", "month", "country_of_origin", "destination_department", "travel_purpose", "entry_point",
    ],
    "fct_hotel_occupancy": ["year", "month", "department"],
    "fct_tourism_gdp": ["year"],
    "fct_migration_flows": ["year", "month", "nationality", "movement_type", "control_point"],
    "fct_air_passengers": ["year", "month", "airport"],
    "fct_tourism_balance": ["year", "quarter"],
    "fct_world_bank_comparison": ["year", "country_code", "indicator_code"],
    "dim_departments": ["dane_code"],
    "dim_date": ["date_day"],
}
