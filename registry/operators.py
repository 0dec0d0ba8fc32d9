"""Operators that no report uses by itself: joins, windows, sets, previews, approximate forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from estratos.operators import aggregates, calendar, joins, sets, sketches, statistics, topk, windows
from estratos.plans import bindings
from registry import tables as t
from registry.base import register
from registry.oracles import big, rnd, sql, whole


@register(
    "latest_order_per_customer", "WF2",
    """select o_custkey, o_orderkey, o_totalprice from (
           select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
           from orders) where rn = 1""",
)
def _latest_order_per_customer(spark, sf):
    latest = windows.latest_row(bindings.table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey")
    return latest.select("o_custkey", "o_orderkey", "o_totalprice")


@register(
    "indicators_pivoted", "AG12",
    sql(
        """select year, country_name, max(case when indicator_code = 'ST.INT.ARVL' then value end) as arrivals,
                  max(case when indicator_code = 'ST.INT.RCPT.CD' then value end) as receipts
           from regional group by 1, 2""",
        "regional",
    ),
)
def _indicators_pivoted(spark, sf):
    value = F.col("value")
    return aggregates.pivot_max(
        bindings.regional(spark, sf), ["year", "country_name"], "indicator_code",
        {"arrivals": ("ST.INT.ARVL", value), "receipts": ("ST.INT.RCPT.CD", value)},
    )


@register(
    "arrivals_with_calendar", "J4",
    sql(
        f"""select month_name, quarter, {big('sum(total_visitors)')} as total_visitors, count(*) as num_rows
            from fct_tourism_arrivals
            join (select period_date, min(month_name) as month_name, min(quarter) as quarter from dim_date group by 1)
            using (period_date) group by 1, 2""",
        "fct_tourism_arrivals", "dim_date",
    ),
)
def _arrivals_with_calendar(spark, sf):
    """The calendar is bounded by the data, so its size is not known in advance and it is not broadcast."""
    joined = joins.with_calendar(t.arrivals(spark, sf), t.dates(spark, sf), ["month_name", "quarter"])
    return joined.groupBy("month_name", "quarter").agg(
        F.sum("total_visitors").alias("total_visitors"), F.count(F.lit(1)).alias("num_rows")
    )


@register(
    "orders_in_named_calendar", "J4 GR1",
    f"""select year, month, count(*) as num_rows from (
            select {whole('year(d)')} as year, {whole('month(d)')} as month, cast(d as date) as period_date
            from (select unnest(generate_series(date '1995-01-01', date '2001-12-01', interval '1 month')) as d))
        join (select cast(date_trunc('month', o_orderdate) as date) as period_date from orders) using (period_date)
        group by 1, 2""",
)
def _orders_in_named_calendar(spark, sf):
    """A calendar between two stated days."""
    start, end = "1995-01-01", "2001-12-31"
    orders = bindings.table(spark, sf, "orders")
    fact = orders.select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("period_date"))
    days = calendar.calendar(calendar.date_spine(spark, start, end))
    joined = joins.with_calendar(fact, days, ["year", "month"])
    return joined.groupBy("year", "month").agg(F.count(F.lit(1)).alias("num_rows"))


@register(
    "months_without_orders", "J5",
    """select period_date from (
           select cast(unnest(generate_series(date '1995-01-01', date '2001-12-01', interval '1 month')) as date)
               as period_date)
       where period_date not in (select cast(date_trunc('month', o_orderdate) as date) from orders)""",
)
def _months_without_orders(spark, sf):
    """Months of the years of the ship dates in which nothing was ordered."""
    fact = bindings.table(spark, sf, "orders").select(
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("period_date")
    )
    bounds = bindings.table(spark, sf, "lineitem").agg(
        F.trunc(F.min("l_shipdate").cast("date"), "year").alias("first"),
        F.add_months(F.trunc(F.max("l_shipdate").cast("date"), "year"), 11).alias("last"),
    )
    return joins.missing_periods(calendar.month_starts(bounds, "first", "last"), fact)


# Every tenth part is named by a key that no part has.
_ITEMS = """(select *, case when l_partkey % 10 = 3 then -l_partkey else l_partkey end as part from lineitem) as items"""


def _items_of_parts(spark, sf):
    part = F.when(F.col("l_partkey") % 10 == 3, -F.col("l_partkey")).otherwise(F.col("l_partkey"))
    return bindings.table(spark, sf, "lineitem").withColumn("part", part)


@register(
    "orphan_part_keys", "J6",
    f"""select part, count(*) as num_rows from {_ITEMS}
        where part not in (select p_partkey from part) group by 1""",
)
def _orphan_part_keys(spark, sf):
    return joins.orphan_keys(_items_of_parts(spark, sf), "part", bindings.table(spark, sf, "part"), "p_partkey")


@register(
    "orphan_part_rows", "J6",
    f"""select l_orderkey, l_linenumber, l_partkey, l_quantity from {_ITEMS}
        where part not in (select p_partkey from part)""",
)
def _orphan_part_rows(spark, sf):
    parts = bindings.table(spark, sf, "part")
    rows = joins.orphan_rows(_items_of_parts(spark, sf), "part", parts, "p_partkey")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@register(
    "orders_by_priority_and_region", "J2",
    """select o_orderpriority, coalesce(r_name, 'none') as r_name, count(*) as num_rows
       from orders left join customer on o_custkey = c_custkey
       left join nation on c_nationkey = n_nationkey
       left join region on n_regionkey = r_regionkey and n_nationkey % 7 <> 0
       group by 1, 2""",
)
def _orders_by_priority_and_region(spark, sf):
    """Look-up with default against a table: some nations name a region that is not in it."""
    key = F.when(F.col("n_nationkey") % 7 == 0, F.lit("?")).otherwise(F.col("n_regionkey").cast("string"))
    orders = bindings.orders_by_nation(spark, sf).select("o_orderpriority", key.alias("region_text"))
    region = bindings.table(spark, sf, "region")
    region = region.select(F.col("r_regionkey").cast("string").alias("region_text_key"), "r_name")
    named = joins.lookup_or_default(orders, "region_text", region, "region_text_key", {"r_name": "none"})
    return named.groupBy("o_orderpriority", "r_name").agg(F.count(F.lit(1)).alias("num_rows"))


_NEW = "cast('2000-01-01' as timestamp)"


@register(
    "new_customers", "SO2",
    f"""select distinct o_custkey from orders where o_orderdate >= {_NEW}
        except select o_custkey from orders where o_orderdate < {_NEW}""",
)
def _new_customers(spark, sf):
    orders = bindings.table(spark, sf, "orders")
    since = F.lit("2000-01-01").cast("timestamp_ntz")
    now, before = orders.where(F.col("o_orderdate") >= since), orders.where(F.col("o_orderdate") < since)
    return sets.unseen(now, before, "o_custkey")


@register(
    "known_customers", "SO2",
    "select distinct o_custkey from orders",
)
def _known_customers(spark, sf):
    orders = bindings.table(spark, sf, "orders")
    since = F.lit("2000-01-01").cast("timestamp_ntz")
    now, before = orders.where(F.col("o_orderdate") >= since), orders.where(F.col("o_orderdate") < since)
    return sets.all_seen(now, before, "o_custkey")


@register(
    "parties_concatenated", "SO1",
    f"""select s_name as name, s_acctbal as balance, cast(null as varchar) as segment from supplier
        union all select c_name, c_acctbal, c_mktsegment from customer
        union all select s_name, s_acctbal, cast(null as varchar) from supplier""",
)
def _parties_concatenated(spark, sf):
    supplier = bindings.table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    customer = bindings.table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"), F.col("c_name").alias("name")
    )
    return sets.concat_by_name([supplier, customer, supplier]).select("name", "balance", "segment")


@register(
    "orders_preview", "SL4 SL3",
    """select o_orderkey, o_totalprice, (select count(*) from orders) as total_rows
       from orders order by o_totalprice, o_orderkey limit 10""",
)
def _orders_preview(spark, sf):
    orders = bindings.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return topk.preview(orders, 10, ["o_totalprice", "o_orderkey"])


@register(
    "load_metrics", "AG15 IO21",
    sql(
        """select count(*) as num_rows, min(year) as year_min, max(year) as year_max,
                  count(distinct country_of_origin) as countries,
                  count(distinct entry_point) as entry_points from arrivals""",
        "arrivals",
    ),
)
def _load_metrics(spark, sf):
    return aggregates.load_metrics(
        bindings.arrivals(spark, sf), distinct={"countries": "country_of_origin", "entry_points": "entry_point"}
    )


@register("load_metrics_approximate", "AG15 AG2 IO21", None)
def _load_metrics_approximate(spark, sf):
    """Distinct customers by sketch: the large-scale form; no SQL gives the same estimate."""
    orders = bindings.table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return aggregates.load_metrics(orders, distinct={"customers": "o_custkey"}, approximate=True)


@register(
    "approximate_counts_hold", "AG15 AG2 IO21",
    f"""select count(*) as num_rows, {whole('min(year(o_orderdate))')} as year_min,
               {whole('max(year(o_orderdate))')} as year_max, true as customers_within_10_percent,
               true as orders_within_10_percent from orders""",
)
def _approximate_counts_hold(spark, sf):
    """The form with sketches: exact columns as they are, estimates held against the exact counts."""
    orders = bindings.table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    counted = {"customers": "o_custkey", "orders": "o_orderkey"}
    rough = aggregates.load_metrics(orders, distinct=counted, approximate=True)
    exact = aggregates.load_metrics(orders, distinct=counted).select(
        F.col("num_rows").alias("_rows"), *[F.col(n).alias(f"exact_{n}") for n in counted]
    )
    near = [
        (F.abs(F.col(n) - F.col(f"exact_{n}")) <= 0.1 * F.col(f"exact_{n}")).alias(f"{n}_within_10_percent") for n in counted
    ]
    both = rough.join(exact, F.col("num_rows") == F.col("_rows"))
    return both.select("num_rows", "year_min", "year_max", *near)


@register(
    "united_sketches", "AG15 AG2 IO21",
    f"""select {whole('year(o_orderdate)')} as year, count(*) as num_rows, true as customers_within_5_percent,
               true as orders_within_5_percent from orders group by 1""",
)
def _united_sketches(spark, sf):
    """Summaries by year and priority, united by year; three standard errors of their estimates are 5 percent."""
    orders = bindings.table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    keys = ["o_custkey", "o_orderkey"]
    rough = sketches.united(sketches.summarised(orders, keys, ["year", "o_orderpriority"]), keys, ["year"])
    exact = orders.groupBy(F.col("year").alias("_year")).agg(*[F.count_distinct(F.col(k)).alias(f"_{k}") for k in keys])
    both = rough.join(exact, F.col("year").eqNullSafe(F.col("_year")))
    held = [F.abs(F.col(f"{k}_count") - F.col(f"_{k}")) <= 0.05 * F.col(f"_{k}") for k in keys]
    return both.select(
        "year", "num_rows", held[0].alias("customers_within_5_percent"), held[1].alias("orders_within_5_percent")
    )


@register(
    "growth_after_zero", "WF3",
    f"""select year, total,
               case when lag(total) over (order by year) <> 0
                    then (cast(total as double) / lag(total) over (order by year) - 1) * 100 end as yoy_pct
        from (select {whole('year(o_orderdate)')} as year,
                     {big("sum(case when year(o_orderdate) = 1997 then 0 else floor(o_totalprice) end)")} as total
              from orders group by 1)""",
)
def _growth_after_zero(spark, sf):
    year = F.year("o_orderdate")
    yearly = bindings.table(spark, sf, "orders").groupBy(year.alias("year")).agg(
        F.sum(F.when(F.year("o_orderdate") == 1997, F.lit(0)).otherwise(F.floor("o_totalprice"))).alias("total")
    )
    return windows.change_pct(yearly, "year", "total", "yoy_pct")


@register(
    "last_order", "WF4",
    "select o_orderkey, o_custkey from orders order by o_orderdate desc, o_orderkey desc limit 1",
)
def _last_order(spark, sf):
    return windows.last_by(bindings.table(spark, sf, "orders"), "o_orderdate", "o_orderkey").select(
        "o_orderkey", "o_custkey"
    )


@register(
    "price_on_quantity_line", "ST-R1",
    f"""select {rnd('regr_slope(l_extendedprice, l_quantity)', 4)} as slope,
               {rnd('regr_intercept(l_extendedprice, l_quantity)', 4)} as intercept,
               {rnd('regr_r2(l_extendedprice, l_quantity)', 6)} as r2,
               {big('regr_count(l_extendedprice, l_quantity)')} as num_points from lineitem""",
)
def _price_on_quantity_line(spark, sf):
    line = statistics.least_squares_line(bindings.table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return t.rounded(t.rounded(line, 4, "slope", "intercept"), 6, "r2")
