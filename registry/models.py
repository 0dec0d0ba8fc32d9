"""Cleaned tables, facts and dimensions (M1-M18) with the expressions they use."""

from __future__ import annotations

from pyspark.sql import functions as F

from estratos.functions import (
    blank, clamp, first_of_month, guarded_pct, mid_month, period_label, period_text_date, rounded_int, scaled,
    surrogate_key, title_case,
)
from estratos.operators import calendar as cal
from estratos.operators.windows import running_totals
from estratos.plans import bindings, gold
from registry import tables as t
from registry.base import register
from registry.oracles import big, key, rnd, sql, tc, whole

for _name, _ids in {
    "stg_tourism_arrivals": "M1 PF10 PF11",
    "stg_hotel_occupancy": "M2 PF6 PF10 PF11 PF18",
    "stg_migracion_flows": "M3 PF10 PF11 PF18",
    "stg_dane_tourism_gdp": "M4 PF10 PF11",
    "stg_aerocivil_passengers": "M5 PF10 PF11 PF18",
    "stg_banrep_tourism_balance": "M6 PF10 PF11",
    "stg_world_bank_arrivals": "M7 PF10 PF11",
    "stg_world_bank_regional": "M8 PF10 PF11",
}.items():
    register(_name, _ids, sql(f"select * from {_name}", _name), lambda spark, sf, n=_name: t.stg(n, spark, sf))


@register(
    "int_arrivals_monthly", "M9 AG1",
    sql(
        f"select * replace ({rnd('total_spending_usd', 6)} as total_spending_usd, "
        f"{rnd('average_spending_usd', 6)} as average_spending_usd) from int_arrivals_monthly",
        "int_arrivals_monthly",
    ),
)
def _int_arrivals_monthly(spark, sf):
    monthly = gold.int_arrivals_monthly(t.stg("stg_tourism_arrivals", spark, sf))
    return t.rounded(monthly, 6, "total_spending_usd", "average_spending_usd")


for _name, _ids in {
    "fct_tourism_arrivals": "M10 AG1 PF16 PF18",
    "fct_hotel_occupancy": "M11 PF15 PF16",
    "fct_migration_flows": "M12 PF16",
    "fct_tourism_gdp": "M13 PF16",
    "fct_air_passengers": "M14 PF15 PF16",
    "fct_world_bank_comparison": "M16 PF16",
}.items():
    register(_name, _ids, sql(f"select * from {_name}", _name), t.FACTS[_name])


@register(
    "fct_tourism_balance", "M15 WF1 PF16",
    sql(
        f"select * replace ({rnd('ytd_income', 6)} as ytd_income, {rnd('ytd_expenditure', 6)} as ytd_expenditure) "
        "from fct_tourism_balance",
        "fct_tourism_balance",
    ),
)
def _fct_tourism_balance(spark, sf):
    return t.rounded(t.balance(spark, sf), 6, "ytd_income", "ytd_expenditure")


register("dim_departments", "M17", sql("select * from departments", "departments"), t.departments)
register("dim_date", "M18 GR2", sql("select * from dim_date", "dim_date"), t.dates)
register("date_spine", "GR1", sql("select * from date_spine", "date_spine"), t.order_days)


@register(
    "running_sums_with_ties", "WF1",
    f"""select {whole('year(o_orderdate)')} as year, {whole('quarter(o_orderdate)')} as quarter, o_orderkey,
               cast(sum(cast(floor(o_totalprice) as bigint)) over (
                   partition by year(o_orderdate) order by quarter(o_orderdate)) as bigint) as ytd_value
        from orders""",
)
def _running_sums_with_ties(spark, sf):
    """Running totals over every order: all orders of a quarter tie, and a year is far too many for a task."""
    orders = bindings.table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"), "o_orderkey",
        F.floor("o_totalprice").alias("value"),
    )
    return running_totals(orders, "year", "quarter", {"ytd_value": "value"}, (1, 9999), (1, 4)).drop("value")


@register(
    "stamped_facts", "PF17",
    sql(
        "select year, count(*) as num_rows, cast('2024-05-01 06:00:00' as timestamp) as loaded_at "
        "from fct_hotel_occupancy group by 1",
        "fct_hotel_occupancy",
    ),
)
def _stamped_facts(spark, sf):
    stamped = gold.fct_hotel_occupancy(t.stg("stg_hotel_occupancy", spark, sf), "2024-05-01 06:00:00")
    return stamped.groupBy("year").agg(
        F.count(F.lit(1)).alias("num_rows"), F.max(F.col("loaded_at").cast("timestamp_ntz")).alias("loaded_at")
    )


@register(
    "title_cased_texts", "PF10 PF11",
    f"""select o_orderpriority, n_name, {tc("'  ' || o_orderpriority || '  ñandú ' || n_name")} as phrase,
               {tc("nullif(o_orderstatus, 'P')")} as status,
               nullif(o_orderstatus, 'P') is null as status_blank, count(*) as num_rows
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
        group by all""",
)
def _title_cased_texts(spark, sf):
    orders = bindings.orders_by_nation(spark, sf)
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    phrase = F.concat(F.lit("  "), "o_orderpriority", F.lit("  ñandú "), "n_name")
    return orders.groupBy(
        "o_orderpriority", "n_name", title_case(phrase).alias("phrase"), title_case(status).alias("status"),
        blank(status).alias("status_blank"),
    ).agg(F.count(F.lit(1)).alias("num_rows"))


@register(
    "number_expressions", "PF6 PF15 PF20",
    f"""select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
               cast(least(greatest(l_quantity * 4 - 50, 0), 100) as double) as clamped,
               case when l_discount > 0
                    then {rnd("l_tax / l_discount * 100", 1)} else cast(0 as double) end as pct,
               {rnd("l_extendedprice / cast(1000 as double)", 1)} as thousands,
               cast(round_even(l_quantity / 2, 0) as integer) as half
        from lineitem""",
)
def _number_expressions(spark, sf):
    return bindings.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
        clamp(F.col("l_quantity") * 4 - 50, 0, 100).alias("clamped"),
        guarded_pct("l_tax", "l_discount").alias("pct"),
        scaled("l_extendedprice", 1e3).alias("thousands"),
        rounded_int(F.col("l_quantity") / 2).alias("half"),
    )


@register(
    "period_expressions", "PF4 PF5 PF18 PF19",
    f"""select o_orderkey, make_date(y, m, 1) as period_date, make_date(y, m, 15) as mid_date,
               cast(y as varchar) || '-Q' || cast(q as varchar) as periodo, make_date(y, m, 1) as fecha
        from (select o_orderkey, {whole('year(o_orderdate)')} as y, {whole('month(o_orderdate)')} as m,
                     quarter(o_orderdate) as q from orders)""",
)
def _period_expressions(spark, sf):
    y, m, q = F.year("o_orderdate"), F.month("o_orderdate"), F.quarter("o_orderdate")
    return bindings.table(spark, sf, "orders").select(
        "o_orderkey", first_of_month(y, m).alias("period_date"), mid_month(y, m).alias("mid_date"),
        period_label(y, q).alias("periodo"), period_text_date(y, m).alias("fecha"),
    )


@register(
    "surrogate_keys", "PF16",
    f"""select o_orderkey, o_orderpriority,
               {key("nullif(o_orderstatus, 'P')", "o_orderpriority", "cast(o_orderdate as date)", "o_custkey")} as id
        from orders""",
)
def _surrogate_keys(spark, sf):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return bindings.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority",
        surrogate_key(status, "o_orderpriority", F.col("o_orderdate").cast("date"), "o_custkey").alias("id"),
    )


@register(
    "order_months", "GR1 GR2",
    sql(
        f"select period_date, {big('count(*)')} as days, {big('count(*) filter (where is_weekend)')} as weekend_days, "
        "min(quarter) as quarter from dim_date group by 1",
        "dim_date",
    ),
)
def _order_months(spark, sf):
    days = cal.calendar(t.order_days(spark, sf))
    return days.groupBy("period_date").agg(
        F.count(F.lit(1)).alias("days"), F.count_if("is_weekend").alias("weekend_days"),
        F.min("quarter").alias("quarter"),
    )
