from datetime import date

import pytest

from estratos import fixed_values as fixed
from estratos.operators import joins, sets, topk, windows
from estratos.plans import pages, reports

ARRIVALS = (
    "arrival_id string, year int, month int, country_of_origin string, destination_department string, "
    "travel_purpose string, entry_point string, total_visitors bigint, total_spending_usd double, "
    "average_spending_usd double"
)


@pytest.fixture
def arrivals(rows):
    return rows(
        [
            ("a", 2018, 1, "Perú", "Antioquia", "Turismo", "Aéreo", 10, 100.25, 10.0),
            ("b", 2019, 1, "Perú", "Antioquia", "Turismo", "Aéreo", 20, 100.25, 20.0),
            ("c", 2019, 2, "Brasil", "Bogotá D.c.", "Negocios", "Marítimo", 5, 50.0, 11.11),
            ("d", 2020, 2, "Brasil", "Nowhere", "Turismo", "Aéreo", 15, 10.0, 30.0),
        ],
        ARRIVALS,
    )


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_growth(arrivals):
    got = values(reports.arrivals_growth(arrivals), "year", "total_visitors", "total_spending_usd", "yoy_pct")
    assert got == [(2018, 10, 100.0, None), (2019, 25, 150.0, 150.0), (2020, 15, 10.0, (15 / 25 - 1) * 100)]


def test_growth_of_one_year_and_after_zero(arrivals, rows):
    assert values(reports.arrivals_growth(arrivals, (2018, 2018)), "yoy_pct") == [(None,)]
    yearly = rows([(2000, 0), (2001, 5), (2002, 10)], "year int, v int")
    assert values(windows.change_pct(yearly, "year", "v", "p"), "p") == [(None,), (None,), (100.0,)]


def test_filters(arrivals):
    assert values(reports.arrivals_growth(arrivals, (2019, 2020), "Antioquia"), "total_visitors") == [(20,)]
    assert reports.arrivals_growth(arrivals, None, fixed.NO_FILTER).count() == 3


def test_a_quote_in_a_choice_is_only_a_value(arrivals):
    assert reports.headline_kpis(arrivals, None, "x' or '1'='1").first().total_visitors is None


def test_kpis(arrivals):
    row = reports.headline_kpis(arrivals).first()
    assert (row.total_visitors, row.total_spending_usd, row.countries_of_origin, row.departments) == (50, 261.0, 2, 3)


def test_top_countries_means_group_means_and_breaks_ties(arrivals, rows):
    got = values(reports.top_countries(arrivals), "country_of_origin", "total_visitors", "avg_spending_usd")
    assert got == [("Perú", 30, 15.0), ("Brasil", 20, 20.56)]
    tied = rows([(c, 1) for c in "cbad"], "k string, v int")
    assert values(topk.top(tied, 2, "v", "k"), "k") == [("a",), ("b",)]


def test_categories(arrivals):
    assert values(reports.visitors_by_purpose(arrivals), "travel_purpose", "total") == [("Turismo", 45), ("Negocios", 5)]
    assert values(reports.visitors_by_entry_point(arrivals), "entry_point", "total") == [("Aéreo", 45), ("Marítimo", 5)]
    assert values(reports.arrivals_seasonality(arrivals), "month_name", "total_visitors") == [("Ene", 30), ("Feb", 20)]


def test_map(arrivals):
    got = {r.dept: (r.visitors, r.lat, r.lon) for r in reports.department_map(arrivals).collect()}
    assert got == {"Antioquia": (30, 6.252, -75.564), "Bogotá D.c.": (5, 4.711, -74.072), "Nowhere": (15, 4.5, -74.0)}
    exact = {r.dept: r.lat for r in reports.department_map(arrivals, fold_case=False).collect()}
    assert exact["Bogotá D.c."] == 4.5


@pytest.fixture
def occupancy(rows):
    return rows(
        [
            ("x", 2020, 1, "A", 50.0, 10, 100.0), ("y", 2020, 2, "A", 70.0, 20, 300.0),
            ("z", 2021, 1, "B", 60.0, 5, 1000.0),
        ],
        "occupancy_id string, year int, month int, department string, occupancy_rate double, available_rooms int, "
        "average_rate_cop double",
    )


def test_occupancy(occupancy):
    summary = reports.occupancy_summary(occupancy)
    assert values(summary, "department", "avg_occupancy", "avg_rate_cop", "total_rooms", "revpar_cop") == [
        ("A", 60.0, 200.0, 30, 120.0), ("B", 60.0, 1000.0, 5, 600.0),
    ]
    assert reports.occupancy_ranking(occupancy, n=1).count() == 1
    assert values(reports.occupancy_trend(occupancy, None, "B"), "fecha", "avg_occupancy") == [(date(2021, 1, 1), 60.0)]
    assert values(pages.department_occupancy(occupancy, "A"), "month", "occupancy_rate") == [(1, 50.0), (2, 70.0)]


def test_gdp(occupancy, rows):
    gdp = rows([(2019, 1.0), (2020, 2.0), (2021, 3.0)], "year int, tourism_gdp_billions_cop double")
    assert reports.gdp_latest(gdp, (2019, 2020)).first().year == 2020
    points = reports.gdp_vs_occupancy(gdp, occupancy.replace(60.0, 80.0, ["occupancy_rate"])).collect()
    assert [(r.year, r.avg_occupancy) for r in points] == [(2020, 60.0), (2021, 80.0)]
    assert [round(r.fitted, 9) for r in points] == [2.0, 3.0]
    line = reports.gdp_occupancy_line(gdp, occupancy.replace(60.0, 80.0, ["occupancy_rate"])).first()
    assert round(line.slope, 9) == 0.05 and line.num_points == 2


def test_migration(rows):
    flows = rows(
        [(2020, "X", "entrada", "P", 10), (2020, "X", "salida", "Q", 4), (2021, "Y", "salida", "Q", 7)],
        "year int, nationality string, movement_type string, control_point string, number_of_travelers int",
    )
    assert values(reports.net_migration(flows), "year", "entradas", "salidas", "balance") == [
        (2020, 10, 4, 6), (2021, 0, 7, -7),
    ]
    assert values(reports.flows_by_year(flows, None, "Salida"), "year", "total_travelers") == [(2020, 4), (2021, 7)]
    assert values(reports.control_points(flows), "control_point", "total_travelers") == [("Q", 11), ("P", 10)]
    assert values(reports.top_nationalities(flows, n=1), "nationality") == [("X",)]


def test_balance(rows):
    fact = rows(
        [("i", 2020, 1, 1.0, 2.0, -1.0), ("j", 2021, 1, 5.0, 2.0, 3.0), ("k", 2021, 2, 1.0, 2.0, -1.0)],
        "balance_id string, year int, quarter int, tourism_income_usd_millions double, "
        "tourism_expenditure_usd_millions double, tourism_balance_usd_millions double",
    )
    assert values(reports.balance_by_quarter(fact), "periodo") == [("2020-Q1",), ("2021-Q1",), ("2021-Q2",)]
    assert values(reports.balance_latest_year(fact), "year", "balance", "outcome") == [(2021, 2.0, "Superávit")]
    assert values(reports.balance_latest_year(fact, (2020, 2020)), "outcome") == [("Déficit",)]


def test_regional_summary_takes_each_indicators_own_last_year(rows):
    fact = rows(
        [
            (2020, "A", "ST.INT.ARVL", 5.0), (2021, "A", "ST.INT.ARVL", 7.0), (2020, "A", "ST.INT.RCPT.CD", 1.26e6),
            (2019, "B", "ST.INT.ARVL", 9.0), (2019, "B", "ST.INT.ARVL", 8.0), (2019, "C", "ST.INT.RCPT.XP.ZS", 1.25),
        ],
        "year int, country_name string, indicator_code string, value double",
    )
    got = values(reports.regional_summary(fact), "country_name", "arrivals", "receipts_usd_m", "pct_exports")
    assert got == [("B", 9.0, None, None), ("A", 7.0, 1.3, None), ("C", None, None, 1.3)]
    assert values(reports.regional_export_share(fact), "country_name", "pct_exports") == [("C", 1.25)]


def test_sets(rows):
    seen, now = rows([("a",), ("b",)], "f string"), rows([("b",), ("c",), ("c",)], "f string")
    assert values(sets.unseen(now, seen, "f"), "f") == [("c",)]
    assert sorted(values(sets.all_seen(now, seen, "f"), "f")) == [("a",), ("b",), ("c",)]


def test_preview(rows):
    df = rows([(i,) for i in range(20)], "x int")
    assert values(topk.preview(df, 2, ["x"]), "x", "total_rows") == [(0, 20), (1, 20)]


def test_gaps_and_orphans(rows, spark):
    from estratos.operators import calendar as cal

    calendar = cal.calendar(cal.date_spine(spark, "2020-01-01", "2020-03-31"))
    fact = rows([(date(2020, 1, 1), 5), (date(2020, 3, 1), 6), (date(2020, 3, 1), 7)], "period_date date, v int")
    assert values(joins.missing_periods(calendar, fact), "period_date") == [(date(2020, 2, 1),)]
    joined = joins.with_calendar(fact, calendar, ["month_name"])
    assert sorted(values(joined, "v", "month_name")) == [(5, "Enero"), (6, "Marzo"), (7, "Marzo")]
    child, parent = rows([(1,), (2,), (2,), (None,)], "k int"), rows([(1,)], "id int")
    assert values(joins.orphan_keys(child, "k", parent, "id"), "k", "num_rows") == [(2, 2)]
    assert values(joins.orphan_rows(child, "k", parent, "id"), "k") == [(2,), (2,)]
