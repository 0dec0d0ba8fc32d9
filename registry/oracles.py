"""SQL for the registered queries, runnable by DuckDB on the given tables.

Written apart from the library, from the definitions of the tables and reports. Common table expressions
are put together by name: a query lists the ones it starts from and gets those they need.
"""

from __future__ import annotations


def tc(c: str) -> str:
    """Title case of a text column."""
    return (
        f"array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split(trim(coalesce({c}, '')), ' ')], ' ')"
    )


def key(*cols: str) -> str:
    """Surrogate key."""
    parts = [f"coalesce(cast({c} as varchar), '_dbt_utils_surrogate_key_null_')" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


def rnd(x: str, digits: int) -> str:
    """Round the shortest decimal form of a double, halves away from zero."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38, 15)), {digits}) as double)"


def big(x: str) -> str:
    return f"cast({x} as bigint)"


def whole(x: str) -> str:
    return f"cast({x} as integer)"


def cents(c: str) -> str:
    return f"cast(floor({c} * 100 + cast(0.5 as double)) as bigint)"


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, *needs: str):
    def add(sql: str) -> None:
        CTES[name] = (needs, sql)

    return add


def sql(final: str, *needs: str) -> str:
    """`with` the needed expressions, in order, followed by the final select."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for need in needs:
        visit(need)
    if not order:
        return final
    return "with " + ",\n".join(f"{name} as ({CTES[name][1]})" for name in order) + "\n" + final


# --- Raw tables ------------------------------------------------------------------------------------

cte("arrivals")(f"""
select cast(o_orderdate as date) as arrival_date, {whole('year(o_orderdate)')} as year,
       {whole('month(o_orderdate)')} as month, n_name as country_of_origin,
       case c_mktsegment when 'AUTOMOBILE' then 'ANTIOQUIA' when 'BUILDING' then 'bogotá D.C.'
            when 'FURNITURE' then 'valle del cauca' when 'HOUSEHOLD' then '  Bolívar '
            else c_mktsegment end as destination_department,
       o_orderpriority as travel_purpose, nullif(o_orderstatus, 'P') as entry_point,
       {big('floor(o_totalprice / 1000)')} as number_of_visitors,
       o_totalprice as estimated_spending_usd
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""")

cte("occupancy")(f"""
select year, month, ' flag ' || l_returnflag || ' ' as department,
       case when l_returnflag = 'N' and month = 2 then null
            else cast(filled as double) * 100 / rooms end as occupancy_rate,
       rooms as available_rooms,
       case when l_returnflag <> 'R' then filled end as occupied_rooms,
       cast(cents as double) / cast(100 as double) / rooms as average_rate_cop
from (select {whole('year(l_shipdate)')} as year, {whole('month(l_shipdate)')} as month, l_returnflag,
             count(*) as rooms, count(*) filter (where l_linestatus = 'F') as filled,
             sum({cents('l_extendedprice')}) as cents
      from lineitem group by all)""")

cte("migration")(f"""
select {whole('year(l_shipdate)')} as year, {whole('month(l_shipdate)')} as month, n_name || ' ' as nationality,
       case when l_returnflag = 'R' then ' Salida ' else 'ENTRADA' end as movement_type,
       l_linestatus as control_point, sum(l_quantity) as number_of_travelers, cast(null as varchar) as source
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
group by 1, 2, 3, 4, 5""")

cte("air")(f"""
select {whole('year(l_shipdate)')} as year, {whole('month(l_shipdate)')} as month, ' ' || p_brand as airport,
       min(p_type) as airport_city,
       sum(l_quantity) filter (where l_linestatus = 'F') as domestic_passengers,
       sum(l_quantity) filter (where l_linestatus = 'O') as international_passengers,
       sum(l_quantity) as total_passengers
from lineitem join part on l_partkey = p_partkey group by 1, 2, 3""")

cte("balance")(f"""
select year, quarter, cast(income as double) / 1e8 as tourism_income_usd_millions,
       cast(expenditure as double) / 1e8 as tourism_expenditure_usd_millions,
       cast(income - expenditure as double) / 1e8 as tourism_balance_usd_millions, ' orders ' as source
from (select {whole('year(o_orderdate)')} as year, {whole('quarter(o_orderdate)')} as quarter,
             sum({cents('o_totalprice')}) filter (where o_orderstatus = 'F') as income,
             sum({cents('o_totalprice')}) filter (where o_orderstatus = 'O') as expenditure
      from orders group by 1, 2)""")

cte("gdp")(f"""
select year, c / 1e11 as tourism_gdp_billions_cop, c * 100 / sum(c) over () as pct_of_total_gdp,
       customers as tourism_employment_thousands,
       (c / lag(c) over (order by year) - 1) * 100 as annual_variation_pct, cast(null as varchar) as source
from (select {whole('year(o_orderdate)')} as year, cast(sum({cents('o_totalprice')}) as double) as c,
             count(distinct o_custkey) as customers from orders group by 1)""")

cte("regional_wide")(f"""
select year, n_nationkey, n_name, n_regionkey, cast(orders as double) as orders,
       cast(cents as double) / cast(100 as double) as revenue,
       case when n_regionkey <= 1 then cast(cents as double) * 100
            / cast(sum(cents) over (partition by year) as double) end as share
from (select {whole('year(o_orderdate)')} as year, n_nationkey, n_name, n_regionkey, count(*) as orders,
             sum({cents('o_totalprice')}) as cents
      from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
      group by 1, 2, 3, 4)""")

cte("regional", "regional_wide")("""
select year, 'N' || lpad(cast(n_nationkey as varchar), 2, '0') as country_code, n_name as country_name,
       indicator_code, indicator_name, value, 'orders' as source
from (select year, n_nationkey, n_name, n_regionkey, 'ST.INT.ARVL' as indicator_code,
             'international_arrivals' as indicator_name, orders as value from regional_wide
      union all
      select year, n_nationkey, n_name, n_regionkey, 'ST.INT.RCPT.CD', 'tourism_receipts_current_usd', revenue
      from regional_wide
      union all
      select year, n_nationkey, n_name, n_regionkey, 'ST.INT.RCPT.XP.ZS', 'tourism_pct_of_exports', share
      from regional_wide)
where value is not null""")

cte("departments")("""
select lpad(cast(n_nationkey as varchar), 2, '0') as dane_code, n_name as department,
       'Capital ' || cast(n_nationkey as varchar) as capital, r_name as region
from nation join region on n_regionkey = r_regionkey""")

# --- Cleaned tables --------------------------------------------------------------------------------

cte("stg_tourism_arrivals", "arrivals")(f"""
select arrival_date, year, month, {tc('country_of_origin')} as country_of_origin,
       {tc('destination_department')} as destination_department, {tc('travel_purpose')} as travel_purpose,
       {tc('entry_point')} as entry_point, coalesce(number_of_visitors, 0) as number_of_visitors,
       coalesce(estimated_spending_usd, 0) as estimated_spending_usd
from arrivals where number_of_visitors >= 0 and year >= 1995 and month between 1 and 12""")

cte("stg_hotel_occupancy", "occupancy")(f"""
select year, month, make_date(year, month, 1) as period_date, {tc('department')} as department,
       least(greatest(occupancy_rate, 0), 100) as occupancy_rate, coalesce(available_rooms, 0) as available_rooms,
       coalesce(occupied_rooms, 0) as occupied_rooms, coalesce(average_rate_cop, 0) as average_rate_cop
from occupancy where year >= 1995 and month between 1 and 12""")

cte("stg_migracion_flows", "migration")("""
select year, month, make_date(year, month, 1) as period_date, trim(nationality) as nationality,
       lower(trim(movement_type)) as movement_type, trim(control_point) as control_point,
       coalesce(cast(number_of_travelers as bigint), 0) as number_of_travelers,
       coalesce(trim(source), 'migracion_colombia') as source
from migration where year >= 1995 and month between 1 and 12 and number_of_travelers > 0""")

cte("stg_dane_tourism_gdp", "gdp")("""
select year, coalesce(tourism_gdp_billions_cop, 0) as tourism_gdp_billions_cop,
       coalesce(pct_of_total_gdp, 0) as pct_of_total_gdp,
       coalesce(tourism_employment_thousands, 0) as tourism_employment_thousands,
       coalesce(annual_variation_pct, 0) as annual_variation_pct, coalesce(trim(source), 'dane') as source
from gdp where year >= 1995 and tourism_gdp_billions_cop > 0""")

cte("stg_aerocivil_passengers", "air")("""
select year, month, make_date(year, month, 1) as period_date, trim(airport) as airport,
       trim(airport_city) as airport_city,
       coalesce(cast(domestic_passengers as bigint), 0) as domestic_passengers,
       coalesce(cast(international_passengers as bigint), 0) as international_passengers,
       coalesce(cast(total_passengers as bigint), 0) as total_passengers
from air where year >= 1995 and month between 1 and 12 and total_passengers > 0""")

cte("stg_banrep_tourism_balance", "balance")("""
select year, quarter, coalesce(tourism_income_usd_millions, 0) as tourism_income_usd_millions,
       coalesce(tourism_expenditure_usd_millions, 0) as tourism_expenditure_usd_millions,
       coalesce(tourism_balance_usd_millions, 0) as tourism_balance_usd_millions,
       coalesce(trim(source), 'banrep') as source
from balance where year >= 1995 and quarter between 1 and 4""")

cte("stg_world_bank_arrivals", "regional")("""
select year, trim(indicator_code) as indicator_code, trim(indicator_name) as indicator_name,
       coalesce(value, 0) as value, trim(country_code) as country_code,
       coalesce(trim(source), 'world_bank') as source
from regional where year >= 1995 and value > 0""")

cte("stg_world_bank_regional", "regional")("""
select year, trim(country_code) as country_code, trim(country_name) as country_name,
       trim(indicator_code) as indicator_code, trim(indicator_name) as indicator_name,
       coalesce(value, 0) as value, coalesce(trim(source), 'world_bank') as source
from regional where year >= 1995 and value > 0""")

# --- Gold ------------------------------------------------------------------------------------------

cte("int_arrivals_monthly", "stg_tourism_arrivals")(f"""
select year, month, country_of_origin, destination_department, travel_purpose, entry_point,
       {big('sum(number_of_visitors)')} as total_visitors, sum(estimated_spending_usd) as total_spending_usd,
       {rnd('sum(estimated_spending_usd)', 6)} / count(estimated_spending_usd) as average_spending_usd,
       count(*) as num_records
from stg_tourism_arrivals group by 1, 2, 3, 4, 5, 6""")

_ARRIVAL_KEY = key(
    "year", "month", "country_of_origin", "destination_department", "travel_purpose", "entry_point"
)
cte("fct_tourism_arrivals", "int_arrivals_monthly")(f"""
select {_ARRIVAL_KEY} as arrival_id, year, month, make_date(year, month, 1) as period_date, country_of_origin,
       destination_department, travel_purpose, entry_point, total_visitors,
       {rnd('total_spending_usd', 2)} as total_spending_usd,
       {rnd('average_spending_usd', 2)} as average_spending_usd, num_records
from int_arrivals_monthly""")

cte("fct_hotel_occupancy", "stg_hotel_occupancy")(f"""
select {key('year', 'month', 'department')} as occupancy_id, year, month, period_date, department,
       occupancy_rate, available_rooms, occupied_rooms, {rnd('average_rate_cop', 0)} as average_rate_cop,
       case when available_rooms > 0
            then {rnd('cast(occupied_rooms as double) / available_rooms * 100', 1)}
            else 0 end as calculated_occupancy
from stg_hotel_occupancy""")

cte("fct_migration_flows", "stg_migracion_flows")(f"""
select {key('year', 'month', 'nationality', 'movement_type', 'control_point')} as migration_id, year, month,
       period_date, nationality, movement_type, control_point, number_of_travelers
from stg_migracion_flows""")

cte("fct_tourism_gdp", "stg_dane_tourism_gdp")(f"""
select {key('year')} as gdp_id, year, tourism_gdp_billions_cop, pct_of_total_gdp,
       tourism_employment_thousands, annual_variation_pct, source
from stg_dane_tourism_gdp""")

cte("fct_air_passengers", "stg_aerocivil_passengers")(f"""
select {key('year', 'month', 'airport')} as passenger_id, year, month, period_date, airport, airport_city,
       domestic_passengers, international_passengers, total_passengers,
       case when total_passengers > 0
            then {rnd('cast(international_passengers as double) / total_passengers * 100', 1)}
            else 0 end as pct_international
from stg_aerocivil_passengers""")

cte("fct_tourism_balance", "stg_banrep_tourism_balance")(f"""
select {key('year', 'quarter')} as balance_id, year, quarter, tourism_income_usd_millions,
       tourism_expenditure_usd_millions, tourism_balance_usd_millions,
       sum(tourism_income_usd_millions) over (partition by year order by quarter) as ytd_income,
       sum(tourism_expenditure_usd_millions) over (partition by year order by quarter) as ytd_expenditure,
       source
from stg_banrep_tourism_balance""")

cte("fct_world_bank_comparison", "stg_world_bank_regional")(f"""
select {key('year', 'country_code', 'indicator_code')} as comparison_id, year, country_code, country_name,
       indicator_code, indicator_name, value, source
from stg_world_bank_regional""")

cte("days")("""
select cast(d as date) as date_day
from (select unnest(generate_series((select min(o_orderdate) from orders), (select max(o_orderdate) from orders),
                                    interval '1 day')) as d)""")

cte("date_spine", "days")(f"""
select date_day, {whole('year(date_day)')} as year, {whole('month(date_day)')} as month,
       {whole('day(date_day)')} as day, {whole('extract(dow from date_day)')} as day_of_week,
       'Q' || cast(month(date_day) % 12 // 3 + 1 as varchar) as quarter
from days""")

cte("dim_date", "date_spine")("""
select date_day, year, month, day, day_of_week, quarter, make_date(year, month, 1) as period_date,
       ['Domingo', 'Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado'][day_of_week + 1] as day_name,
       ['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto', 'Septiembre', 'Octubre',
        'Noviembre', 'Diciembre'][month] as month_name,
       day_of_week in (0, 6) as is_weekend
from date_spine""")

MONTH_SHORT = "['Ene', 'Feb', 'Mar', 'Abr', 'May', 'Jun', 'Jul', 'Ago', 'Sep', 'Oct', 'Nov', 'Dic'][month]"

COORDINATES = """(values ('antioquia', 6.252::double, -75.564::double), ('bogotá d.c.', 4.711, -74.072),
    ('valle del cauca', 3.452, -76.532), ('bolívar', 10.4, -75.514)) as c(dept_key, clat, clon)"""



def dsum(c: str, digits: int) -> str:
    """Exact sum of values rounded to some digits."""
    return f"cast(sum(cast({c} as decimal(18, {digits}))) as double)"


def davg(c: str, digits: int) -> str:
    return f"({dsum(c, digits)} / count({c}))"


SPEND = rnd(dsum("total_spending_usd", 2), 0)
