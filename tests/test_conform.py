from datetime import date

import pytest
from pyspark.sql import Observation

from estratos import fixed_values as fixed
from estratos.operators import conform
from estratos.plans import bronze


def text(rows, header, *lines):
    names = header.split(",")
    schema = ", ".join(f"`{n}` string" for n in names)
    return rows([tuple(v or None for v in line.split(",")) for line in lines], schema)


def test_spanish_headers(rows):
    raw = text(
        rows,
        "anio,mes,pais_origen,departamento_destino,numero_visitantes,gasto_estimado_usd,motivo_viaje,punto_entrada,"
        "fecha_llegada",
        "2031,5,Islandia,Vaupés,71,9134.5,Estudio,Fluvial,2031-05-09",
        "2031,6,Ghana,Caldas,13,270.25,Salud,Terrestre,2031-06-30",
    )
    got = bronze.arrivals_csv(raw).orderBy("month").collect()
    assert [r.number_of_visitors for r in got] == [71, 13]
    assert [r.estimated_spending_usd for r in got] == [9134.5, 270.25]
    assert got[0].arrival_date == date(2031, 5, 9) and got[1].travel_purpose == "Salud"


def test_header_variants_and_defaults(rows):
    raw = text(
        rows, "año,mes,pais,departamento_destino,llegadas,fecha_llegada",
        "2033,7,Nepal,Guainía,42,2033-07-01", "2033,8,Omán,Sucre,6,2033-08-31",
    )
    got = bronze.arrivals_csv(raw).orderBy("month").collect()
    assert [r.number_of_visitors for r in got] == [42, 6]
    assert {(r.travel_purpose, r.entry_point, r.estimated_spending_usd) for r in got} == {("Turismo", "Aéreo", 0.0)}


@pytest.mark.parametrize("name", ["Pais de Residencia", " pais-de-residencia ", "PAÍS DE RESIDENCIA", "country_of_origin"])
def test_headers_are_compared_folded(name):
    claimed, unmapped = conform.match_headers([name, "Otra Cosa"], fixed.ARRIVALS_HEADERS)
    assert claimed == {"country_of_origin": [name]} and unmapped == ["Otra Cosa"]


def test_two_headers_of_one_target_are_merged_in_order(rows):
    raw = text(rows, "year,month,llegadas,visitantes,x.y", "2020,1,5,,a", "2020,2,6,7,b", "2020,3,,,c")
    got = bronze.arrivals_csv(raw).orderBy("month").collect()
    assert [r.number_of_visitors for r in got] == [5, 7, 0]
    assert [r["x.y"] for r in got] == ["a", "b", "c"]


def test_header_report():
    report = conform.header_report(
        ["año", "llegadas", "visitantes", "nota"], fixed.ARRIVALS_HEADERS, ["year", "month", "number_of_visitors"]
    )
    assert report.renamed == {"año": "year", "visitantes": "number_of_visitors"}
    assert report.merged == {"number_of_visitors": ["visitantes", "llegadas"]}
    assert report.unmapped == ["nota"] and report.defaulted == ["month"]


def test_parts_from_dates(rows):
    raw = text(rows, "fecha_llegada,total", "2019-07-04,3", "junk,4")
    got = bronze.arrivals_csv(raw).collect()
    assert [(r.year, r.month, r.arrival_date, r.number_of_visitors) for r in got] == [(2019, 7, date(2019, 7, 4), 3)]


@pytest.mark.parametrize(
    ("texts", "months"),
    [
        (["03/04/2022", "15/04/2022", "2022-05-06"], [4, 4, 5]),  # the day first, settled by the 15th
        (["03/04/2022", "04/15/2022", "6-7-2022"], [3, 4, 6]),  # the month first
        (["03/04/2022", "05/06/2022"], [3, 5]),  # nothing settles it: the month first
        (["03/04/2022", "15/04/2022", "04/16/2022"], [3, 4, 4]),  # as many votes for either: the month first
        (["03/04/2022", "15/04/2022", "16/04/2022", "04/17/2022"], [4, 4, 4, 4]),  # the majority
        (["03-04-2022 x", "03/04/2022 10:11", "31/12/2022"], [None, 4, 12]),
    ],
)
def test_a_column_of_dates_has_one_order(rows, texts, months):
    got = conform.conform_arrivals(rows([(t, 2022, 1) for t in texts], "arrival_date string, year int, month int"))
    found = {r.arrival_date.month if r.arrival_date else None: 0 for r in got.collect()}
    assert sorted((r.arrival_date.month if r.arrival_date else 0) for r in got.collect()) == sorted(m or 0 for m in months), found


def test_date_is_built_when_never_filled(rows):
    raw = text(rows, "year,month,arrival_date", "2019,7,", "2020,8,")
    assert {r.arrival_date for r in bronze.arrivals_csv(raw).collect()} == {date(2019, 7, 15), date(2020, 8, 15)}


def test_date_stays_null_when_partly_filled(rows):
    raw = text(rows, "year,month,arrival_date", "2019,7,2019-07-02", "2020,8,")
    got = {r.year: r.arrival_date for r in bronze.arrivals_csv(raw).collect()}
    assert got == {2019: date(2019, 7, 2), 2020: None}


def test_periods_outside_are_dropped(rows):
    raw = text(rows, "year,month", "2009,1", "2010,0", "2010,1", "2010,12", "2010,13", "abc,1", ",1", "2011.0,2.9")
    got = sorted((r.year, r.month) for r in bronze.arrivals_csv(raw).collect())
    assert got == [(2010, 1), (2010, 12), (2011, 2)]


def test_present_nulls_of_texts_stay(rows):
    raw = text(rows, "year,month,pais", "2020,1,")
    assert bronze.arrivals_csv(raw).first().country_of_origin is None


def test_occupied_rooms_derived(rows):
    raw = text(
        rows,
        "anio,mes,departamento,porcentaje_ocupacion,habitaciones_disponibles,tarifa_promedio_cop",
        "2022,5,Antioquia,60.0,1000,200000.0",
    )
    row = bronze.occupancy_csv(raw).first()
    assert (row.occupied_rooms, row.occupancy_rate, row.average_rate_cop) == (600, 60.0, 200000.0)


def test_occupancy_out_of_range(rows):
    raw = text(
        rows, "year,month,department,ocupacion,available_rooms,occupied_rooms",
        "2022,1,A,150.0,1000,0", "2022,2,A,-10.0,1000,0", "2022,3,A,x,1000,",
    )
    got = bronze.occupancy_csv(raw).orderBy("month").collect()
    assert [(r.occupancy_rate, r.occupied_rooms) for r in got] == [(100.0, 0), (0.0, 0), (50.0, 0)]


def test_occupied_rooms_never_filled_are_derived(rows):
    raw = text(rows, "year,month,ocupacion,available_rooms,occupied_rooms", "2022,1,33.3,10,", "2022,2,99.9,10,")
    got = bronze.occupancy_csv(raw).orderBy("month").collect()
    assert [r.occupied_rooms for r in got] == [3, 9]
    assert {r.department for r in got} == {"Desconocido"}


@pytest.mark.parametrize("totals, expected", [(("0", "0"), [3, 7]), (("0", "5"), [0, 5]), (("", ""), [3, 7])])
def test_air_totals(rows, totals, expected):
    raw = text(
        rows, "año,mes,aeropuerto,pasajeros_nacionales,pasajeros_internacionales,total_pasajeros",
        f"2020,1,BOG,1,2,{totals[0]}", f"2020,2,BOG,3,4,{totals[1]}",
    )
    assert [r.total_passengers for r in bronze.air_csv(raw).orderBy("month").collect()] == expected


def test_air_total_absent(rows):
    raw = text(rows, "año,mes,pasajeros_nacionales,pasajeros_internacionales", "2020,1,1,2")
    row = bronze.air_csv(raw).first()
    assert (row.total_passengers, row.airport, row.airport_city) == (3, "Desconocido", "Desconocido")


def test_balance(rows):
    raw = text(rows, "año,trimestre,ingresos,egresos", "2006,1,10.5,4.0", "2005,1,1,1", "2007,5,1,1", "2008,x,2,3")
    got = bronze.balance_csv(raw).orderBy("year").collect()
    assert [(r.year, r.quarter, r.tourism_balance_usd_millions) for r in got] == [(2006, 1, 6.5), (2008, 1, -1.0)]


def test_given_balance_is_kept(rows):
    raw = text(rows, "año,trimestre,ingresos,egresos,balance", "2006,1,10,4,99", "2006,2,10,4,")
    got = bronze.balance_csv(raw).orderBy("quarter").collect()
    assert [r.tourism_balance_usd_millions for r in got] == [99.0, None]


def test_datasets_kept_as_landed(rows):
    gdp = bronze.gdp_csv(text(rows, "anio,tourism_gdp_billions_cop,source", "2020,1.5,", "1900,x,y"))
    assert [(r.year, r.tourism_gdp_billions_cop, r.source, r.pct_of_total_gdp) for r in gdp.collect()] == [
        (2020, 1.5, None, None), (1900, None, "y", None),
    ]
    flows = text(
        rows, "anio,mes,nationality,movement_type,control_point,number_of_travelers", "2020,1,X,entrada,P,12.0",
        "2020,1,X,entrada,P,2.5", "2020,1,X,entrada,P,3.5", "2020,1,X,entrada,P,junk",
    )
    got = bronze.migration_csv(flows)
    assert [r.number_of_travelers for r in got.collect()] == [12, 2, 4, None]
    assert {r.source for r in got.collect()} == {"migracion_colombia"}


def test_gaps_of_drops_reach_the_cleaned_tables(rows):
    """A missing count drops the row and a missing rate counts as 0, where a conformed load would default both."""
    from estratos.plans import silver

    arrivals = text(rows, "año,mes,pais,llegadas", "2020,1,A,", "2020,1,B,x", "2020,1,C,7")
    got = silver.stg_tourism_arrivals(bronze.as_landed("arrivals", arrivals)).collect()
    assert [(r.country_of_origin, r.number_of_visitors, r.entry_point) for r in got] == [("C", 7, "Aéreo")]
    occupancy = text(rows, "year,month,department,ocupacion", "2020,1,a,", "2020,2,a,30")
    rates = silver.stg_hotel_occupancy(bronze.as_landed("occupancy", occupancy)).orderBy("month").collect()
    assert [r.occupancy_rate for r in rates] == [0.0, 30.0]


@pytest.mark.parametrize("first", ["año", '"año"'])
def test_byte_order_mark(spark, tmp_path, first):
    from estratos.sources import readers

    (tmp_path / "bom.csv").write_text(f"\ufeff{first},mes,llegadas\n2020,1,5\n", "utf-8")
    row = bronze.arrivals_csv(readers.read_csv(spark, f"{tmp_path}/bom.csv")).first()
    assert (row.year, row.month, row.number_of_visitors) == (2020, 1, 5)


def test_counts_are_64_bit(rows):
    raw = text(rows, "year,month,llegadas", "2020,1,6000000000")
    assert bronze.arrivals_csv(raw).first().number_of_visitors == 6_000_000_000


def test_catalogue(rows):
    df = rows([("ST.INT.ARVL", "PER"), ("nope", "XXX")], "indicator_code string, country_code string")
    got = conform.with_country_name(conform.with_indicator_name(df)).collect()
    assert [(r.indicator_name, r.country_name) for r in got] == [("international_arrivals", "Perú"), (None, None)]


def test_conforming_runs_no_job_until_read(spark, rows):
    """The decisions on whole columns are subqueries of the plan."""
    raw = text(rows, "year,month,arrival_date", "2019,7,")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("conform", "conform")
    bronze.arrivals_csv(raw)
    assert list(tracker.getJobIdsForGroup("conform")) == []


def test_a_date_text_is_parsed_once(rows):
    """However many columns come from the date; reading in either order names the format twice."""
    df = conform.conform_arrivals(text(rows, "fecha_llegada", "15/04/2022", "03/05/2022"), 1990, Observation())
    assert sorted(str(r.arrival_date) for r in df.collect()) == ["2022-04-15", "2022-05-03"]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(") and plan.count(", yyyyMMdd,") == 2, plan
