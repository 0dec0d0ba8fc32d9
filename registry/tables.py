"""Cleaned and gold tables over the given data, for the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estratos.operators import calendar as cal
from estratos.plans import bindings, gold, silver

START = bindings.FIRST_YEAR
Years = tuple[int, int] | None

SILVER = {
    "stg_tourism_arrivals": (silver.stg_tourism_arrivals, bindings.arrivals),
    "stg_hotel_occupancy": (silver.stg_hotel_occupancy, bindings.occupancy),
    "stg_migracion_flows": (silver.stg_migracion_flows, bindings.migration),
    "stg_dane_tourism_gdp": (silver.stg_dane_tourism_gdp, bindings.gdp),
    "stg_aerocivil_passengers": (silver.stg_aerocivil_passengers, bindings.air),
    "stg_banrep_tourism_balance": (silver.stg_banrep_tourism_balance, bindings.balance),
    "stg_world_bank_arrivals": (silver.stg_world_bank_arrivals, bindings.regional),
    "stg_world_bank_regional": (silver.stg_world_bank_regional, bindings.regional),
}


def stg(name: str, spark: SparkSession, sf: str, years: Years = None) -> DataFrame:
    model, source = SILVER[name]
    return model(source(spark, sf, years), min_year=START)


def arrivals(spark: SparkSession, sf: str, years: Years = None) -> DataFrame:
    return gold.fct_tourism_arrivals(gold.arrivals_monthly(bindings.arrivals(spark, sf, years), START), None)


def occupancy(spark: SparkSession, sf: str, years: Years = None) -> DataFrame:
    return gold.fct_hotel_occupancy(stg("stg_hotel_occupancy", spark, sf, years), None)


def migration(spark: SparkSession, sf: str, years: Years = None) -> DataFrame:
    return gold.fct_migration_flows(stg("stg_migracion_flows", spark, sf, years), None)


def gdp(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fct_tourism_gdp(stg("stg_dane_tourism_gdp", spark, sf), None)


def air(spark: SparkSession, sf: str, years: Years = None) -> DataFrame:
    return gold.fct_air_passengers(stg("stg_aerocivil_passengers", spark, sf, years), None)


def balance(spark: SparkSession, sf: str, years: Years = None) -> DataFrame:
    return gold.fct_tourism_balance(stg("stg_banrep_tourism_balance", spark, sf, years), None)


def regional(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fct_world_bank_comparison(stg("stg_world_bank_regional", spark, sf), None)


def departments(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_departments(bindings.departments(spark, sf), None)


def order_days(spark: SparkSession, sf: str) -> DataFrame:
    """The spine from the first to the last order date."""
    orders = bindings.table(spark, sf, "orders")
    bounds = orders.agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return cal.days_between(bounds, "first", "last")


def dates(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_date(order_days(spark, sf), None)


FACTS = {
    "fct_tourism_arrivals": arrivals,
    "fct_hotel_occupancy": occupancy,
    "fct_tourism_gdp": gdp,
    "fct_migration_flows": migration,
    "fct_air_passengers": air,
    "fct_tourism_balance": balance,
    "fct_world_bank_comparison": regional,
    "dim_departments": departments,
    "dim_date": dates,
}


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round sums of doubles, whose last bits depend on the order of addition, before comparing."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
