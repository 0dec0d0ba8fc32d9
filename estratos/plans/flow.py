"""The whole run: bronze loads, cleaned views, gold tables, checks.

Cleaned tables are lazy; Spark folds them into the gold plans. Bronze and gold are written, and each gold
table is computed from written bronze and read back for the checks, so a lost executor costs at most the
table it was working on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from estratos import fixed_values as fixed
from estratos.operators import calendar as cal
from estratos.plans import bronze, gold, silver, suites
from estratos.schemas import BRONZE, DEPARTMENT_SEED
from estratos.sources import readers, sinks


@dataclass
class RunConfig:
    """Where to read and write, and what to fall back to.

    `landed` names the landed files of a dataset where there are any: a CSV path, or a list of name patterns
    for drops of differing headers, or a path of JSON answers for the indicator datasets. `fallbacks` holds a
    conformed frame for each dataset. `departments` is the seed CSV or a frame. The year limits, by dataset,
    replace the defaults of the bronze loads and of the cleaned tables. `encoding` names the encoding of the landed
    files of a dataset where it is not UTF-8, `one_line` the datasets in whose cells there are no line
    breaks, which saves a pass over their files. With `database` the gold tables are also made known to the catalogue
    there, as in `gold.fct_tourism_arrivals`.
    """

    root: str
    fallbacks: Mapping[str, DataFrame]
    departments: str | DataFrame
    landed: Mapping[str, str | Sequence[str]] = field(default_factory=dict)
    loaded_at: datetime | str = gold.NOW
    on: date | None = None
    calendar_start: str = fixed.CALENDAR_START
    calendar_end: str = fixed.CALENDAR_END
    encoding: Mapping[str, str] = field(default_factory=dict)
    one_line: Sequence[str] = ()
    bronze_min_years: Mapping[str, int] = field(default_factory=dict)
    min_years: Mapping[str, int] = field(default_factory=dict)
    threads: int = 4
    database: str | None = None


# Facts whose years are worth a directory each, so that a filter on years skips files.
YEAR_PARTITIONED = (
    "fct_tourism_arrivals", "fct_hotel_occupancy", "fct_migration_flows", "fct_air_passengers",
    "fct_world_bank_comparison",
)


def bronze_path(config: RunConfig, table: str) -> str:
    return f"{config.root}/bronze/{table}"


def gold_path(config: RunConfig, table: str) -> str:
    return f"{config.root}/gold/{table}"


def load_bronze(spark: SparkSession, config: RunConfig) -> list[bronze.LoadReport]:
    """All bronze loads, a few at a time."""

    def one(table: str) -> bronze.LoadReport:
        common = {"archive": f"{config.root}/archive", "on": config.on, "min_year": config.bronze_min_years.get(table)}
        source = spark, table, config.landed.get(table), config.fallbacks[table], bronze_path(config, table)
        if table in bronze.INDICATOR_TABLES:
            return bronze.load_indicators(*source, **common)
        return bronze.load(
            *source, **common, encoding=config.encoding.get(table, "UTF-8"), multiline=table not in config.one_line
        )

    with ThreadPoolExecutor(config.threads) as pool:
        return list(pool.map(one, BRONZE))


def _raw(spark: SparkSession, config: RunConfig, table: str) -> DataFrame:
    return readers.read_table(spark, bronze_path(config, table), BRONZE[table])


def _limits(config: RunConfig, table: str) -> dict[str, int]:
    return {"min_year": config.min_years[table]} if table in config.min_years else {}


def silver_tables(spark: SparkSession, config: RunConfig) -> dict[str, DataFrame]:
    """The cleaned tables as lazy views over written bronze."""

    models = {
        "stg_tourism_arrivals": (silver.stg_tourism_arrivals, "arrivals"),
        "stg_hotel_occupancy": (silver.stg_hotel_occupancy, "occupancy"),
        "stg_migracion_flows": (silver.stg_migracion_flows, "migration"),
        "stg_dane_tourism_gdp": (silver.stg_dane_tourism_gdp, "gdp"),
        "stg_aerocivil_passengers": (silver.stg_aerocivil_passengers, "air"),
        "stg_banrep_tourism_balance": (silver.stg_banrep_tourism_balance, "balance"),
        "stg_world_bank_arrivals": (silver.stg_world_bank_arrivals, "indicators"),
        "stg_world_bank_regional": (silver.stg_world_bank_regional, "regional"),
    }
    tables = {
        name: model(_raw(spark, config, table), **_limits(config, table)) for name, (model, table) in models.items()
    }
    for name, df in tables.items():
        sinks.publish_view(df, name)
    return tables


def gold_plans(spark: SparkSession, config: RunConfig, stg: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The lazy plans of all gold tables."""
    at = config.loaded_at
    seed = config.departments
    if isinstance(seed, str):
        seed = readers.read_seed(spark, seed, DEPARTMENT_SEED)
    return {
        "fct_tourism_arrivals": gold.fct_tourism_arrivals(
            gold.arrivals_monthly(_raw(spark, config, "arrivals"), **_limits(config, "arrivals")), at
        ),
        "fct_hotel_occupancy": gold.fct_hotel_occupancy(stg["stg_hotel_occupancy"], at),
        "fct_migration_flows": gold.fct_migration_flows(stg["stg_migracion_flows"], at),
        "fct_tourism_gdp": gold.fct_tourism_gdp(stg["stg_dane_tourism_gdp"], at),
        "fct_air_passengers": gold.fct_air_passengers(stg["stg_aerocivil_passengers"], at),
        "fct_tourism_balance": gold.fct_tourism_balance(stg["stg_banrep_tourism_balance"], at),
        "fct_world_bank_comparison": gold.fct_world_bank_comparison(stg["stg_world_bank_regional"], at),
        "dim_departments": gold.dim_departments(seed, at),
        "dim_date": gold.dim_date(cal.date_spine(spark, config.calendar_start, config.calendar_end), at),
    }


def write_gold(spark: SparkSession, config: RunConfig, plans: Mapping[str, DataFrame]) -> dict[str, int]:
    """Write the gold tables, a few at a time, and return their numbers of rows."""
    if config.database is not None:
        spark.sql(f"create database if not exists `{config.database}`")

    def one(table: str) -> int:
        keys = ["year"] if table in YEAR_PARTITIONED else []
        name = None if config.database is None else f"`{config.database}`.{table}"
        return int(sinks.write_parquet(plans[table], gold_path(config, table), keys, name)["num_rows"])

    with ThreadPoolExecutor(config.threads) as pool:
        futures = {table: pool.submit(one, table) for table in plans}
        return {table: future.result() for table, future in futures.items()}


def read_gold(spark: SparkSession, config: RunConfig, plans: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The written gold tables, with the schemas of their plans."""
    return {
        table: readers.read_table(spark, gold_path(config, table), df.schema).select(*df.columns)
        for table, df in plans.items()
    }


@dataclass
class RunResult:
    """Load reports, row counts, the written gold tables and the lazy quality report."""

    loads: list[bronze.LoadReport]
    rows: dict[str, int]
    gold: dict[str, DataFrame]
    checks: DataFrame


def run(spark: SparkSession, config: RunConfig) -> RunResult:
    """Load, clean, build and check everything. Failed checks are reported and do not stop the run."""
    loads = load_bronze(spark, config)
    stg = silver_tables(spark, config)
    plans = gold_plans(spark, config, stg)
    rows = write_gold(spark, config, plans)
    written = read_gold(spark, config, plans)
    checks = suites.quality_report({**stg, **written}, {**suites.SILVER, **suites.GOLD})
    return RunResult(loads, rows, written, checks)
