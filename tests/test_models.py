from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from estratos.operators import calendar as cal
from estratos.operators.windows import running_totals
from estratos.plans import gold, silver
from estratos.schemas import BRONZE, GRAIN


def arrivals(rows, *data):
    base = dict(
        arrival_date=date(2020, 1, 15), year=2020, month=1, country_of_origin="PERÚ", destination_department="meta",
        travel_purpose=" turismo ", entry_point=None, number_of_visitors=3, estimated_spending_usd=10.5,
    )
    return rows([tuple({**base, **d}[n] for n in BRONZE["arrivals"].names) for d in data], BRONZE["arrivals"])


def test_arrivals_filter_boundaries(rows):
    df = arrivals(
        rows, {"year": 2014}, {"year": 2015}, {"month": 0}, {"month": 12}, {"month": 13},
        {"number_of_visitors": -1}, {"number_of_visitors": 0}, {"number_of_visitors": None}, {"year": None},
    )
    got = sorted((r.year, r.month, r.number_of_visitors) for r in silver.stg_tourism_arrivals(df).collect())
    assert got == [(2015, 1, 3), (2020, 1, 0), (2020, 12, 3)]


def test_arrivals_texts_and_defaults(rows):
    row = silver.stg_tourism_arrivals(arrivals(rows, {"estimated_spending_usd": None})).first()
    assert (row.country_of_origin, row.travel_purpose, row.entry_point) == ("Perú", "Turismo", "")
    assert row.estimated_spending_usd == 0.0


def test_fractional_columns_are_rounded_half_to_even(rows):
    df = rows(
        [(2020.0, 1.0, "N", "Entrada ", "P", 2.5, None), (2020.0, 1.0, "N", " SALIDA", "P", 3.5, " x ")],
        "year double, month double, nationality string, movement_type string, control_point string, "
        "number_of_travelers double, source string",
    )
    got = silver.stg_migracion_flows(df).orderBy("movement_type").collect()
    assert [(r.movement_type, r.number_of_travelers, r.source) for r in got] == [
        ("entrada", 2, "migracion_colombia"), ("salida", 4, "x"),
    ]


def test_migration_needs_travelers(rows):
    df = rows(
        [(2015, 1, "N", "e", "P", n, None) for n in (0, None, 1)] + [(2014, 1, "N", "e", "P", 1, None)],
        BRONZE["migration"],
    )
    assert silver.stg_migracion_flows(df).count() == 1


def test_occupancy_rates(rows):
    df = rows(
        [(2020, m, " la guajira", r, 10, 5, 99.5) for m, r in enumerate([None, -1.0, 150.0, 40.0], 1)],
        BRONZE["occupancy"],
    )
    got = silver.stg_hotel_occupancy(df).orderBy("month").collect()
    assert [r.occupancy_rate for r in got] == [0.0, 0.0, 100.0, 40.0]
    assert got[0].department == "La Guajira" and got[0].period_date == date(2020, 1, 1)
    kept = silver.stg_hotel_occupancy(df, preserve_null=True).orderBy("month").first()
    assert kept.occupancy_rate is None


@pytest.mark.parametrize(
    "model, table, good, bad",
    [
        (silver.stg_dane_tourism_gdp, "gdp", (2010, 1.0, None, None, None, None), (2009, 1.0, 1.0, 1, 1.0, "s")),
        (silver.stg_dane_tourism_gdp, "gdp", (2010, 1.0, None, None, None, None), (2010, 0.0, 1.0, 1, 1.0, "s")),
        (silver.stg_banrep_tourism_balance, "balance", (2006, 4, None, 1.0, None, None), (2005, 4, 1.0, 1.0, 1.0, "s")),
        (silver.stg_banrep_tourism_balance, "balance", (2006, 1, None, 1.0, None, None), (2006, 5, 1.0, 1.0, 1.0, "s")),
        (silver.stg_aerocivil_passengers, "air", (2010, 12, " a ", "c", None, 1, 1), (2010, 12, "a", "c", 1, 1, 0)),
        (silver.stg_world_bank_arrivals, "indicators", (2010, "c", "n", 0.1, "k", "n", None), (2010, "c", "n", 0.0, "k", "n", None)),
        (silver.stg_world_bank_regional, "regional", (2010, "k", "n", "c", "n", 0.1, None), (2010, "k", "n", "c", "n", None, None)),
    ],
)
def test_validity_and_defaults(rows, model, table, good, bad):
    got = model(rows([good, bad], BRONZE[table])).collect()
    assert len(got) == 1
    assert None not in [v for k, v in got[0].asDict().items()]


def test_monthly_arrivals(rows):
    df = arrivals(
        rows,
        {"estimated_spending_usd": 10.0}, {"estimated_spending_usd": 5.0, "country_of_origin": " perú"},
        {"estimated_spending_usd": None, "number_of_visitors": 4}, {"month": 2}, {"entry_point": "  "},
    )
    direct = gold.int_arrivals_monthly(silver.stg_tourism_arrivals(df))
    early = gold.arrivals_monthly(df)
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, early.select(direct.columns).collect()))
    january = early.where("month = 1").collect()
    assert len(january) == 1
    row = january[0]
    assert (row.total_visitors, row.total_spending_usd, row.num_records) == (13, 25.5, 4)
    assert row.average_spending_usd == 6.375


def test_fact_arrivals(rows):
    fact = gold.fct_tourism_arrivals(gold.arrivals_monthly(arrivals(rows, {})), datetime(2024, 5, 1))
    row = fact.first()
    assert row.period_date == date(2020, 1, 1) and row.loaded_at == datetime(2024, 5, 1)
    assert fact.columns[0] == "arrival_id" and fact.columns[-1] == "loaded_at"
    assert "loaded_at" not in gold.fct_tourism_arrivals(gold.arrivals_monthly(arrivals(rows, {})), None).columns


def test_guarded_ratios(rows):
    stg = silver.stg_hotel_occupancy(rows([(2020, 1, "a", 1.0, 0, 5, 2.5), (2020, 2, "a", 1.0, 3, 1, 3.5)], BRONZE["occupancy"]))
    got = gold.fct_hotel_occupancy(stg, None).orderBy("month").collect()
    assert [(r.calculated_occupancy, r.average_rate_cop) for r in got] == [(0.0, 3.0), (33.3, 4.0)]


def balance_fact(rows, *data):
    stg = rows([(y, q, i, e, i - e, "s") for y, q, i, e in data], BRONZE["balance"])
    return gold.fct_tourism_balance(stg, None)


def test_year_to_date(rows):
    got = balance_fact(rows, (2020, 1, 1.0, 2.0), (2020, 2, 3.0, 1.0), (2020, 4, 5.0, 0.0), (2021, 1, 7.0, 7.0))
    assert [(r.ytd_income, r.ytd_expenditure) for r in got.orderBy("year", "quarter").collect()] == [
        (1.0, 2.0), (4.0, 3.0), (9.0, 3.0), (7.0, 7.0),
    ]


def test_year_to_date_shares_ties_and_keeps_corrupt_keys(rows):
    df = rows(
        [(2020, 1, 1), (2020, 1, 2), (2020, 2, 4), (99999, 1, 8), (99999, 3, 16), (None, 1, 32), (2020, None, 64), (2020, 0, 128)],
        "year int, quarter int, v int",
    )
    got = running_totals(df, "year", "quarter", {"ytd": "v"}, (1, 9999), (1, 4))
    want = {
        (2020, 0, 128): 128, (2020, 1, 1): 131, (2020, 1, 2): 131, (2020, 2, 4): 135, (2020, None, 64): 199,
        (99999, 1, 8): 8, (99999, 3, 16): 24, (None, 1, 32): 32,
    }
    assert {(r.year, r.quarter, r.v): r.ytd for r in got.collect()} == want


def test_too_many_keys_outside_the_domains_are_an_error_and_not_lost(rows, monkeypatch):
    from estratos.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_ROWS", 4)
    df = rows([(y, 1, 1) for y in (1, 2, 10, 11, 12, 13)], "year int, quarter int, v int")
    assert running_totals(df, "year", "quarter", {"ytd": "v"}, (1, 2), (1, 2)).count() == 6
    many = df.unionAll(rows([(14, 1, 1)], "year int, quarter int, v int"))
    with pytest.raises(Exception, match="state larger domains"):
        running_totals(many, "year", "quarter", {"ytd": "v"}, (1, 2), (1, 2)).collect()
    assert running_totals(many, "year", "quarter", {"ytd": "v"}, (1, 99), (1, 2)).count() == 7


def test_running_totals_agree_with_a_plain_window(spark):
    from pyspark.sql import Window

    df = spark.range(5000).select(
        (F.col("id") % 9 + 1995).cast("int").alias("year"), (F.col("id") % 4 + 1).cast("int").alias("quarter"),
        (F.col("id") * 7 % 13).alias("v"), "id",
    )
    plain = df.withColumn("ytd", F.sum("v").over(Window.partitionBy("year").orderBy("quarter")))
    ours = running_totals(df, "year", "quarter", {"ytd": "v"}, (1, 9999), (1, 4))
    assert ours.select(plain.columns).exceptAll(plain).isEmpty() and ours.count() == 5000


def test_calendar(spark):
    days = gold.dim_date(cal.date_spine(spark), None)
    assert days.count() == 2922
    by_day = {r.date_day: r for r in days.where("month in (2, 12)").collect()}
    leap, last = by_day[date(2024, 2, 29)], by_day[date(2026, 12, 31)]
    assert (leap.day_name, leap.month_name, leap.quarter, leap.is_weekend) == ("Jueves", "Febrero", "Q1", False)
    assert (last.quarter, last.year, last.period_date, last.day_of_week) == ("Q1", 2026, date(2026, 12, 1), 4)


def test_months_spanned():
    assert cal.months_spanned("2019-01-01", "2026-12-31") == 96
    assert cal.months_spanned("2020-01-31", "2020-01-31") == 1


def test_every_grain_is_in_its_key_order():
    assert GRAIN["fct_tourism_arrivals"][:2] == ["year", "month"] and GRAIN["fct_tourism_gdp"] == ["year"]
