"""The analytical questions (Q1-Q29, E1-E7)."""

from __future__ import annotations

from estratos.plans import pages, reports
from registry import tables as t
from registry.base import register
from registry.oracles import COORDINATES, MONTH_SHORT, SPEND, big, cte, davg, rnd, sql

# A range and a department for the filtered forms; the unfiltered forms read everything.
YEARS = (1996, 2000)
DEPARTMENT = "Bolívar"
ARRIVALS_FILTER = f"where year between {YEARS[0]} and {YEARS[1]} and destination_department = '{DEPARTMENT}'"
IN_YEARS = f"where year between {YEARS[0]} and {YEARS[1]}"


def _arrivals(fn, **options):
    return lambda spark, sf: fn(t.arrivals(spark, sf), **options)


register("arrival_years", "Q1 PF14",
         sql("select distinct year from fct_tourism_arrivals", "fct_tourism_arrivals"),
         _arrivals(reports.arrival_years))
register("arrival_departments", "Q2 PF14",
         sql("select distinct destination_department from fct_tourism_arrivals", "fct_tourism_arrivals"),
         _arrivals(reports.arrival_departments))
register("occupancy_departments", "Q3 PF14",
         sql("select distinct department from fct_hotel_occupancy", "fct_hotel_occupancy"),
         lambda spark, sf: reports.occupancy_departments(t.occupancy(spark, sf)))

_KPIS = f"""select {big('sum(total_visitors)')} as total_visitors, {SPEND} as total_spending_usd,
    count(distinct country_of_origin) as countries_of_origin,
    count(distinct destination_department) as departments from fct_tourism_arrivals """
register("headline_kpis", "Q4 AG2", sql(_KPIS, "fct_tourism_arrivals"), _arrivals(reports.headline_kpis))
register("headline_kpis_filtered", "Q4 AG2 PF13", sql(_KPIS + ARRIVALS_FILTER, "fct_tourism_arrivals"),
         lambda spark, sf: reports.headline_kpis(t.arrivals(spark, sf, YEARS), YEARS, DEPARTMENT))

_YEARLY = f"""select year, {big('sum(total_visitors)')} as total_visitors, {SPEND} as total_spending_usd
    from fct_tourism_arrivals {{where}} group by year"""


def _growth(where: str) -> str:
    return sql(
        f"""select year, total_visitors, total_spending_usd,
                   (cast(total_visitors as double) / lag(total_visitors) over (order by year) - 1) * 100 as yoy_pct
            from ({_YEARLY.format(where=where)})""",
        "fct_tourism_arrivals",
    )


register("arrivals_growth", "Q5 AG4 WF3", _growth(""), _arrivals(reports.arrivals_growth))
register("arrivals_growth_filtered", "Q5 AG4 WF3 PF13", _growth(ARRIVALS_FILTER),
         lambda spark, sf: reports.arrivals_growth(t.arrivals(spark, sf, YEARS), YEARS, DEPARTMENT))


def _top_countries(where: str, spending: str) -> str:
    return sql(
        f"""select country_of_origin, {big('sum(total_visitors)')} as total_visitors,
                   {rnd(davg('average_spending_usd', 2), 2)} as {spending}
            from fct_tourism_arrivals {where} group by country_of_origin
            order by total_visitors desc, country_of_origin limit 10""",
        "fct_tourism_arrivals",
    )


register("top_countries", "Q6 SL1", _top_countries("", "avg_spending_usd"), _arrivals(reports.top_countries))
register("top_countries_filtered", "Q6 SL1 PF13", _top_countries(ARRIVALS_FILTER, "avg_spending_usd"),
         lambda spark, sf: reports.top_countries(t.arrivals(spark, sf, YEARS), YEARS, DEPARTMENT))

for _name, _ids, _column, _fn in [
    ("visitors_by_purpose", "Q7 AG6", "travel_purpose", reports.visitors_by_purpose),
    ("visitors_by_entry_point", "Q8 AG6", "entry_point", reports.visitors_by_entry_point),
]:
    register(_name, _ids,
             sql(f"select {_column}, {big('sum(total_visitors)')} as total from fct_tourism_arrivals group by 1",
                 "fct_tourism_arrivals"),
             _arrivals(_fn))

register("arrivals_seasonality", "Q9 AG5 J3",
         sql(f"""select month, {big('sum(total_visitors)')} as total_visitors, {MONTH_SHORT} as month_name
                 from fct_tourism_arrivals group by month""", "fct_tourism_arrivals"),
         _arrivals(reports.arrivals_seasonality))
register("department_map", "Q10 AG7 J2",
         sql(f"""select dept, visitors, coalesce(clat, 4.5::double) as lat, coalesce(clon, -74.0::double) as lon
                 from (select destination_department as dept, {big('sum(total_visitors)')} as visitors
                       from fct_tourism_arrivals group by 1)
                 left join {COORDINATES} on lower(dept) = dept_key""", "fct_tourism_arrivals"),
         _arrivals(reports.department_map))
register("department_map_exact", "Q10 AG7 J2",
         sql(f"""select dept, visitors, coalesce(clat, 4.5::double) as lat, coalesce(clon, -74.0::double) as lon
                 from (select destination_department as dept, {big('sum(total_visitors)')} as visitors
                       from fct_tourism_arrivals group by 1)
                 left join {COORDINATES} on lower(dept) = dept_key and dept <> 'Bogotá D.c.'""",
             "fct_tourism_arrivals"),
         _arrivals(reports.department_map, fold_case=False))

_TREND = f"""select year, month, department, {rnd('avg(occupancy_rate)', 1)} as avg_occupancy,
    make_date(year, month, 1) as fecha from fct_hotel_occupancy {{where}} group by year, month, department"""
register("occupancy_trend", "Q11 AG8 PF19", sql(_TREND.format(where=""), "fct_hotel_occupancy"),
         lambda spark, sf: reports.occupancy_trend(t.occupancy(spark, sf)))
register("occupancy_trend_filtered", "Q11 AG8 PF13 PF19",
         sql(_TREND.format(where=IN_YEARS + " and department = 'Flag A'"), "fct_hotel_occupancy"),
         lambda spark, sf: reports.occupancy_trend(t.occupancy(spark, sf, YEARS), YEARS, "Flag A"))

_SUMMARY = f"""select department, {rnd('avg(occupancy_rate)', 1)} as avg_occupancy,
    {rnd(davg('average_rate_cop', 0), 0)} as avg_rate_cop, {big('sum(available_rooms)')} as total_rooms,
    {rnd('avg(occupancy_rate) * ' + davg('average_rate_cop', 0) + ' / 100', 0)} as revpar_cop
    from fct_hotel_occupancy group by department"""
register("occupancy_summary", "Q12 AG9", sql(_SUMMARY, "fct_hotel_occupancy"),
         lambda spark, sf: reports.occupancy_summary(t.occupancy(spark, sf)))
register("occupancy_ranking", "Q12 AG9 SL2",
         sql(_SUMMARY + " order by avg_occupancy desc, department limit 15", "fct_hotel_occupancy"),
         lambda spark, sf: reports.occupancy_ranking(t.occupancy(spark, sf)))

register("gdp_by_year", "Q13", sql(f"select * from fct_tourism_gdp {IN_YEARS}", "fct_tourism_gdp"),
         lambda spark, sf: reports.gdp_by_year(t.gdp(spark, sf), YEARS))
register("gdp_of_all_years", "Q13", sql("select * from fct_tourism_gdp", "fct_tourism_gdp"),
         lambda spark, sf: reports.gdp_by_year(t.gdp(spark, sf)))
register("gdp_latest", "Q13 WF4",
         sql("select * from fct_tourism_gdp order by year desc limit 1", "fct_tourism_gdp"),
         lambda spark, sf: reports.gdp_latest(t.gdp(spark, sf)))

cte("gdp_points", "fct_tourism_gdp", "fct_hotel_occupancy")(f"""
select g.year as year, tourism_gdp_billions_cop as y, avg_occupancy as x from fct_tourism_gdp as g
join (select year, {rnd('avg(occupancy_rate)', 1)} as avg_occupancy from fct_hotel_occupancy group by year) as o
on g.year = o.year""")
cte("gdp_line", "gdp_points")("""
select regr_slope(y, x) as b, regr_intercept(y, x) as a, regr_r2(y, x) as r2, regr_count(y, x) as n
from gdp_points""")
register("gdp_vs_occupancy", "Q14 AG8 J1 ST-R1",
         sql(f"""select year, y as tourism_gdp_billions_cop, x as avg_occupancy, {rnd('a + b * x', 8)} as fitted
                 from gdp_points, gdp_line""", "gdp_line"),
         lambda spark, sf: t.rounded(reports.gdp_vs_occupancy(t.gdp(spark, sf), t.occupancy(spark, sf)), 8, "fitted"))
register("gdp_occupancy_line", "Q14 ST-R1",
         sql(f"""select {rnd('b', 8)} as slope, {rnd('a', 8)} as intercept, {rnd('r2', 8)} as r2,
                        {big('n')} as num_points from gdp_line""", "gdp_line"),
         lambda spark, sf: t.rounded(
             reports.gdp_occupancy_line(t.gdp(spark, sf), t.occupancy(spark, sf)), 8, "slope", "intercept", "r2"))

_TRAVELERS = big("sum(number_of_travelers)")
register("flows_by_year", "Q15 AG10",
         sql(f"""select year, movement_type, {_TRAVELERS} as total_travelers from fct_migration_flows
                 group by 1, 2""", "fct_migration_flows"),
         lambda spark, sf: reports.flows_by_year(t.migration(spark, sf)))
register("flows_by_year_filtered", "Q15 AG10 PF13",
         sql(f"""select year, movement_type, {_TRAVELERS} as total_travelers from fct_migration_flows
                 {IN_YEARS} and movement_type = 'salida' group by 1, 2""", "fct_migration_flows"),
         lambda spark, sf: reports.flows_by_year(t.migration(spark, sf, YEARS), YEARS, "Salida"))
register("net_migration", "Q16 AG11",
         sql("""select year, coalesce(i, 0) as entradas, coalesce(o, 0) as salidas,
                       coalesce(i, 0) - coalesce(o, 0) as balance
                from (select year, cast(sum(number_of_travelers) filter (movement_type = 'entrada') as bigint) as i,
                             cast(sum(number_of_travelers) filter (movement_type = 'salida') as bigint) as o
                      from fct_migration_flows group by year)""", "fct_migration_flows"),
         lambda spark, sf: reports.net_migration(t.migration(spark, sf)))
register("top_nationalities", "Q17 SL1",
         sql(f"""select nationality, movement_type, {_TRAVELERS} as total_travelers from fct_migration_flows
                 group by 1, 2 order by total_travelers desc, nationality, movement_type limit 10""",
             "fct_migration_flows"),
         lambda spark, sf: reports.top_nationalities(t.migration(spark, sf)))
register("control_points", "Q18 AG6",
         sql(f"select control_point, {_TRAVELERS} as total_travelers from fct_migration_flows group by 1",
             "fct_migration_flows"),
         lambda spark, sf: reports.control_points(t.migration(spark, sf)))

register("air_kpis", "Q19 AG3",
         sql(f"""select {big('sum(total_passengers)')} as total, {big('sum(domestic_passengers)')} as domestic,
                        {big('sum(international_passengers)')} as international,
                        count(distinct airport) as airports from fct_air_passengers""", "fct_air_passengers"),
         lambda spark, sf: reports.air_kpis(t.air(spark, sf)))
register("air_by_year", "Q20 AG4",
         sql(f"""select year, {big('sum(domestic_passengers)')} as domestic,
                        {big('sum(international_passengers)')} as international,
                        {big('sum(total_passengers)')} as total from fct_air_passengers group by year""",
             "fct_air_passengers"),
         lambda spark, sf: reports.air_by_year(t.air(spark, sf)))
register("airport_ranking", "Q21 AG13",
         sql(f"""select airport, airport_city, {big('sum(total_passengers)')} as total,
                        {big('sum(international_passengers)')} as international,
                        {rnd(davg('pct_international', 1), 1)} as pct_intl from fct_air_passengers group by 1, 2""",
             "fct_air_passengers"),
         lambda spark, sf: reports.airport_ranking(t.air(spark, sf)))
register("air_seasonality", "Q22 AG5 J3",
         sql(f"""select month, {big('sum(total_passengers)')} as total, {MONTH_SHORT} as month_name
                 from fct_air_passengers group by month""", "fct_air_passengers"),
         lambda spark, sf: reports.air_seasonality(t.air(spark, sf)))

_QUARTERS = f"""select * replace ({rnd('ytd_income', 6)} as ytd_income, {rnd('ytd_expenditure', 6)} as ytd_expenditure),
    cast(year as varchar) || '-Q' || cast(quarter as varchar) as periodo from fct_tourism_balance """
register("balance_of_all_quarters", "Q23 PF19", sql(_QUARTERS, "fct_tourism_balance"),
         lambda spark, sf: t.rounded(
             reports.balance_by_quarter(t.balance(spark, sf)), 6, "ytd_income", "ytd_expenditure"))
register("balance_by_quarter", "Q23 PF13 PF19", sql(_QUARTERS + IN_YEARS, "fct_tourism_balance"),
         lambda spark, sf: t.rounded(
             reports.balance_by_quarter(t.balance(spark, sf, YEARS), YEARS), 6, "ytd_income", "ytd_expenditure"))

_BALANCE = f"""select year, {rnd('sum(tourism_income_usd_millions)', 6)} as income,
    {rnd('sum(tourism_expenditure_usd_millions)', 6)} as expenditure,
    {rnd('sum(tourism_balance_usd_millions)', 6)} as balance from fct_tourism_balance group by year"""
register("balance_by_year", "Q24 AG4", sql(_BALANCE, "fct_tourism_balance"),
         lambda spark, sf: t.rounded(
             reports.balance_by_year(t.balance(spark, sf)), 6, "income", "expenditure", "balance"))
register("balance_latest_year", "Q24 WF4",
         sql(f"""select *, case when balance > 0 then 'Superávit' else 'Déficit' end as outcome
                 from ({_BALANCE}) order by year desc limit 1""", "fct_tourism_balance"),
         lambda spark, sf: t.rounded(
             reports.balance_latest_year(t.balance(spark, sf)), 6, "income", "expenditure", "balance"))

register("regional_arrivals", "Q25",
         sql("""select year, country_name, value from fct_world_bank_comparison
                where indicator_code = 'ST.INT.ARVL'""", "fct_world_bank_comparison"),
         lambda spark, sf: reports.regional_arrivals(t.regional(spark, sf)))
register("regional_receipts", "Q26 PF20",
         sql(f"""select year, country_name, {rnd('value / 1e6', 1)} as value_millions from fct_world_bank_comparison
                 where indicator_code = 'ST.INT.RCPT.CD'""", "fct_world_bank_comparison"),
         lambda spark, sf: reports.regional_receipts(t.regional(spark, sf)))
register("regional_export_share", "Q27",
         sql(f"""select year, country_name, {rnd('value', 8)} as pct_exports from fct_world_bank_comparison
                 where indicator_code = 'ST.INT.RCPT.XP.ZS'""", "fct_world_bank_comparison"),
         lambda spark, sf: t.rounded(reports.regional_export_share(t.regional(spark, sf)), 8, "pct_exports"))
register("regional_summary", "Q28 WF2 AG12 PF20",
         sql(f"""select country_name, a as arrivals, {rnd('r / 1e6', 1)} as receipts_usd_m,
                        {rnd('s', 1)} as pct_exports
                 from (select country_name, arg_max(value, year) filter (indicator_code = 'ST.INT.ARVL') as a,
                              arg_max(value, year) filter (indicator_code = 'ST.INT.RCPT.CD') as r,
                              arg_max(value, year) filter (indicator_code = 'ST.INT.RCPT.XP.ZS') as s
                       from fct_world_bank_comparison group by country_name)""", "fct_world_bank_comparison"),
         lambda spark, sf: reports.regional_summary(t.regional(spark, sf)))

# --- Second dashboard ------------------------------------------------------------------------------

register("page_department_list", "E1 PF14",
         sql("select distinct destination_department as department from fct_tourism_arrivals",
             "fct_tourism_arrivals"),
         _arrivals(pages.department_list))
register("page_department_arrivals", "E2 AG14",
         sql(f"""select year, month, {big('sum(total_visitors)')} as total_visitors, {SPEND} as total_spending_usd
                 from fct_tourism_arrivals where destination_department = 'Antioquia' group by 1, 2""",
             "fct_tourism_arrivals"),
         _arrivals(pages.department_arrivals, department="Antioquia"))
register("page_department_occupancy", "E3",
         sql("""select year, month, occupancy_rate, average_rate_cop from fct_hotel_occupancy
                where department = 'Flag N'""", "fct_hotel_occupancy"),
         lambda spark, sf: pages.department_occupancy(t.occupancy(spark, sf), "Flag N"))
register("page_arrivals_by_year", "E4 AG4", sql(_YEARLY.format(where=""), "fct_tourism_arrivals"),
         _arrivals(pages.arrivals_by_year))
register("page_top_countries", "E5 SL1", _top_countries("", "average_spending_usd"),
         _arrivals(pages.top_countries))
register("page_occupancy_trend", "E6 SL3",
         sql("select year, month, department, occupancy_rate from fct_hotel_occupancy", "fct_hotel_occupancy"),
         lambda spark, sf: pages.occupancy_trend(t.occupancy(spark, sf)))
register("page_seasonality", "E7 AG5",
         sql(f"""select month, {big('sum(total_visitors)')} as total_visitors,
                        {rnd(davg('average_spending_usd', 2), 2)} as average_spending
                 from fct_tourism_arrivals group by month""", "fct_tourism_arrivals"),
         _arrivals(pages.seasonality))
