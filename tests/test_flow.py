from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from estratos.plans import bindings, flow, reports
from estratos.schemas import BRONZE, GRAIN


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    """A run on the smallest tables: arrivals and one country's answers have landed, the rest falls back."""
    sf, root = "/root/testdata/sf0.001", tmp_path_factory.mktemp("run")
    raw = bindings.arrivals(spark, sf)
    spanish = raw.withColumnsRenamed({"year": "año", "month": "mes", "number_of_visitors": "llegadas"})
    spanish.where("`año` < 1998").write.option("header", True).csv(f"{root}/landed/llegadas_old")
    raw.where("year >= 1998").select(*reversed(raw.columns)).write.option("header", True).csv(
        f"{root}/landed/arrivals_new"
    )
    bindings.air(spark, sf).write.option("header", True).csv(f"{root}/landed/air")
    bindings.indicator_payloads(spark, sf).repartition(1).select("payload").where(
        F.col("country_code") == "N01"
    ).limit(1).write.text(f"{root}/landed/indicators")
    sources = {
        "arrivals": raw.limit(1), "occupancy": bindings.occupancy(spark, sf), "gdp": bindings.gdp(spark, sf),
        "migration": bindings.migration(spark, sf), "air": bindings.air(spark, sf),
        "balance": bindings.balance(spark, sf), "indicators": bindings.regional(spark, sf),
        "regional": bindings.regional(spark, sf),
    }
    fallbacks = {
        name: df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE[name]])
        for name, df in sources.items()
    }
    config = flow.RunConfig(
        root=f"{root}/lake",
        fallbacks=fallbacks,
        departments=bindings.departments(spark, sf),
        landed={"arrivals": [f"{root}/landed/{p}" for p in ("*arrivals*", "*llegadas*", "*none*")], "gdp": [f"{root}/none*"], "air": f"{root}/landed/air",
                "indicators": f"{root}/landed/indicators/*.txt",
                "balance": f"{root}/landed/never"},
        loaded_at=datetime(2024, 5, 1, 6),
        on=date(2024, 5, 1),
        calendar_start="1995-01-01",
        calendar_end="2001-12-31",
        bronze_min_years={"air": 1996, "indicators": 1990},
        min_years={name: 1995 for name in BRONZE},
        database="gold",
    )
    return config, flow.run(spark, config)


def test_loads_report_their_source(finished):
    loads = {load.table: load for load in finished[1].loads}
    assert set(loads) == set(BRONZE)
    assert {name for name, load in loads.items() if load.source_used == "landed"} == {"arrivals", "air", "indicators"}
    arrivals = loads["arrivals"]
    assert (arrivals.num_rows, arrivals.year_min, arrivals.year_max, arrivals.rows_dropped) == (1500, 1995, 2001, 0)
    air = loads["air"]
    assert air.source_used == "landed" and air.year_min == 1996
    assert air.num_rows + air.rows_dropped == 1907 and air.rows_dropped > 0
    assert arrivals.headers.merged["year"] == ["year", "año"] and arrivals.headers.unmapped == []


def test_gold_is_complete(finished):
    result = finished[1]
    assert set(result.gold) == set(GRAIN)
    assert result.rows["fct_hotel_occupancy"] == 249
    assert result.rows["dim_date"] == 2557
    assert result.rows["fct_tourism_balance"] == 27
    for name, df in result.gold.items():
        assert df.count() == result.rows[name], name
        assert df.columns[-1] == "loaded_at"
        assert df.select("loaded_at").distinct().collect() == [(datetime(2024, 5, 1, 6),)]


def test_checks_run_on_written_tables(finished):
    report = {(r.table, r.check, r.column): r.n_failed for r in finished[1].checks.collect()}
    assert report[("fct_tourism_arrivals", "unique", "arrival_id")] == 0
    assert report[("fct_hotel_occupancy", "agrees_with_calculated_occupancy", "occupancy_rate")] > 0
    assert report[("dim_date", "between", "year")] == 2557
    assert len(report) == 101


def test_reports_on_written_gold(finished, spark):
    fact = finished[1].gold["fct_tourism_arrivals"]
    growth = {r.year: r.total_visitors for r in reports.arrivals_growth(fact).collect()}
    assert (growth[1995], growth[2000], growth[2001]) == (61166, 56239, 30536)
    filtered = reports.arrivals_growth(fact, (1996, 1997))
    assert "PartitionFilters: [isnotnull(year" in filtered._jdf.queryExecution().executedPlan().toString()


def test_raw_copies_are_kept(finished, spark):
    config = finished[0]
    kept = spark.read.parquet(f"{config.root}/archive/arrivals/ingest_date=2024-05-01")
    assert kept.where(F.col("value").startswith("arrival_date")).count() >= 1
    assert kept.where(F.col("value").startswith("estimated_spending_usd")).count() >= 1
    assert spark.read.parquet(f"{config.root}/archive/indicators/ingest_date=2024-05-01").count() == 1


def test_gold_can_be_asked_in_sql(finished, spark):
    got = spark.sql(
        "select year, sum(total_visitors) as v from gold.fct_tourism_arrivals where year between 2000 and 2001 "
        "group by year order by year"
    ).collect()
    assert [tuple(r) for r in got] == [(2000, 56239), (2001, 30536)]
    for name in GRAIN:
        assert spark.table(f"gold.{name}").count() == finished[1].rows[name]


def test_silver_views_are_there(finished, spark):
    kept = finished[1].loads[0].num_rows
    assert spark.sql("select count(*) as n from stg_tourism_arrivals").first().n == kept
