"""The test star schema shaped as the canonical raw tables.

Every measure that is a sum of money is summed in whole cents, so it does not depend on the order of the
rows. Some values are set to null, padded or put in another case on purpose, to exercise the cleaning.
`years` adds a range filter on the raw timestamp, which the Parquet scan can use to skip row groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estratos import fixed_values as fixed

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Market segment to raw department text: padded, upper or lower case, one left as an unknown department.
DEPARTMENTS = {
    "AUTOMOBILE": "ANTIOQUIA",
    "BUILDING": "bogotá D.C.",
    "FURNITURE": "valle del cauca",
    "HOUSEHOLD": "  Bolívar ",
}

FIRST_YEAR = 1995


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; its schema is stated, so no job is run to infer it."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _within(df: DataFrame, column: str, years: tuple[int, int] | None) -> DataFrame:
    if years is None:
        return df
    start = F.lit(f"{years[0]:04d}-01-01").cast("timestamp_ntz")
    end = F.lit(f"{years[1] + 1:04d}-01-01").cast("timestamp_ntz")
    return df.where((F.col(column) >= start) & (F.col(column) < end))


def _cents(column: str) -> Column:
    return F.floor(F.col(column) * 100 + 0.5)


def _amount(cents: Column, unit: float = 1.0) -> Column:
    """Exact sum of cents as a double in multiples of `unit`."""
    return cents.cast("double") / (100.0 * unit)


def orders_by_nation(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Orders with their customer and nation.

    Sides are joined smallest-last with no hints: Spark broadcasts a table whose files are below its size
    threshold and otherwise sorts and merges, where AQE splits a customer with very many orders.
    """
    orders = _within(table(spark, sf_dir, "orders"), "o_orderdate", years)
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )


def arrivals(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """One arrival per order."""
    pairs = [F.lit(text) for pair in DEPARTMENTS.items() for text in pair]
    segment = F.col("c_mktsegment")
    return orders_by_nation(spark, sf_dir, years).select(
        F.col("o_orderdate").alias("arrival_date"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.col("n_name").alias("country_of_origin"),
        F.coalesce(F.try_element_at(F.create_map(*pairs), segment), segment).alias("destination_department"),
        F.col("o_orderpriority").alias("travel_purpose"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("entry_point"),
        F.floor(F.col("o_totalprice") / 1000).alias("number_of_visitors"),
        F.col("o_totalprice").alias("estimated_spending_usd"),
    )


def occupancy(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Line items by ship month and return flag; flag R has no occupied rooms, flag N no rate in February."""
    items = _within(table(spark, sf_dir, "lineitem"), "l_shipdate", years)
    filled = F.count_if(F.col("l_linestatus") == "F")
    grouped = items.groupBy(
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), "l_returnflag"
    ).agg(
        F.count(F.lit(1)).alias("rooms"), filled.alias("filled"), F.sum(_cents("l_extendedprice")).alias("cents")
    )
    flag = F.col("l_returnflag")
    return grouped.select(
        "year",
        "month",
        F.concat(F.lit(" flag "), flag, F.lit(" ")).alias("department"),
        F.when(~((flag == "N") & (F.col("month") == 2)), F.col("filled") * 100.0 / F.col("rooms")).alias(
            "occupancy_rate"
        ),
        F.col("rooms").alias("available_rooms"),
        F.when(flag != "R", F.col("filled")).alias("occupied_rooms"),
        (_amount(F.col("cents")) / F.col("rooms")).alias("average_rate_cop"),
    )


def migration(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Quantities shipped by month, supplier nation, return flag R or not, and line status."""
    items = _within(table(spark, sf_dir, "lineitem"), "l_shipdate", years)
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    joined = items.join(supplier, items.l_suppkey == supplier.s_suppkey).join(
        nation, supplier.s_nationkey == nation.n_nationkey
    )
    grouped = joined.groupBy(
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        "n_name",
        (F.col("l_returnflag") == "R").alias("returned"),
        "l_linestatus",
    ).agg(F.sum("l_quantity").alias("number_of_travelers"))
    return grouped.select(
        "year",
        "month",
        F.concat(F.col("n_name"), F.lit(" ")).alias("nationality"),
        F.when(F.col("returned"), F.lit(" Salida ")).otherwise(F.lit("ENTRADA")).alias("movement_type"),
        F.col("l_linestatus").alias("control_point"),
        "number_of_travelers",
        F.lit(None).cast("string").alias("source"),
    )


def air(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Quantities shipped by month and brand; line status F is domestic, O international.

    The smallest part type is taken from sums per type: a minimum of texts next to the sums over all line
    items would make Spark sort them instead of hashing.
    """
    items = _within(table(spark, sf_dir, "lineitem"), "l_shipdate", years)
    part = table(spark, sf_dir, "part")
    quantity = F.col("l_quantity")
    by_type = (
        items.join(part, items.l_partkey == part.p_partkey)
        .groupBy(
            F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), "p_brand", "p_type"
        )
        .agg(
            F.sum(F.when(F.col("l_linestatus") == "F", quantity)).alias("domestic"),
            F.sum(F.when(F.col("l_linestatus") == "O", quantity)).alias("international"),
            F.sum(quantity).alias("total"),
        )
    )
    grouped = by_type.groupBy("year", "month", "p_brand").agg(
        F.min("p_type").alias("airport_city"),
        F.sum("domestic").alias("domestic_passengers"),
        F.sum("international").alias("international_passengers"),
        F.sum("total").alias("total_passengers"),
    )
    airport = F.concat(F.lit(" "), F.col("p_brand")).alias("airport")
    return grouped.select("year", "month", airport, *grouped.columns[3:])


def balance(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Orders by quarter; status F is income, O expenditure, in millions."""
    orders = _within(table(spark, sf_dir, "orders"), "o_orderdate", years)
    cents = _cents("o_totalprice")
    grouped = orders.groupBy(
        F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")
    ).agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", cents)).alias("income"),
        F.sum(F.when(F.col("o_orderstatus") == "O", cents)).alias("expenditure"),
    )
    return grouped.select(
        "year",
        "quarter",
        _amount(F.col("income"), 1e6).alias("tourism_income_usd_millions"),
        _amount(F.col("expenditure"), 1e6).alias("tourism_expenditure_usd_millions"),
        _amount(F.col("income") - F.col("expenditure"), 1e6).alias("tourism_balance_usd_millions"),
        F.lit(" orders ").alias("source"),
    )


def gdp(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Orders by year: value, share of all years, customers and change; windows run on the yearly rows."""
    orders = _within(table(spark, sf_dir, "orders"), "o_orderdate", years)
    yearly = orders.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.sum(_cents("o_totalprice")).alias("cents"), F.count_distinct("o_custkey").alias("customers")
    )
    by_year = Window.orderBy("year")
    cents = F.col("cents").cast("double")
    every = F.sum("cents").over(Window.partitionBy()).cast("double")
    return yearly.select(
        "year",
        _amount(F.col("cents"), 1e9).alias("tourism_gdp_billions_cop"),
        (cents * 100 / every).alias("pct_of_total_gdp"),
        F.col("customers").alias("tourism_employment_thousands"),
        ((cents / F.lag(cents).over(by_year) - 1) * 100).alias("annual_variation_pct"),
        F.lit(None).cast("string").alias("source"),
    )


def regional(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Orders by year and nation as three indicators in long form.

    The third indicator, the nation's share of the year, exists for nations of regions 0 and 1 only.
    """
    grouped = (
        orders_by_nation(spark, sf_dir, years)
        .groupBy(F.year("o_orderdate").alias("year"), "n_nationkey", "n_name", "n_regionkey")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum(_cents("o_totalprice")).alias("cents"))
    )
    year_cents = F.sum("cents").over(Window.partitionBy("year")).cast("double")
    wide = grouped.withColumn("share", F.col("cents").cast("double") * 100 / year_cents)

    def entry(code: str, value: Column) -> Column:
        return F.struct(
            F.lit(code).alias("indicator_code"), F.lit(fixed.INDICATORS[code]).alias("indicator_name"),
            value.alias("value"),
        )

    share = F.when(F.col("n_regionkey") <= 1, F.col("share"))
    entries = F.array(
        entry(fixed.ARRIVALS_CODE, F.col("orders").cast("double")),
        entry(fixed.RECEIPTS_CODE, _amount(F.col("cents"))),
        entry(fixed.EXPORT_SHARE_CODE, share),
    )
    return wide.select(
        "year",
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("country_code"),
        F.col("n_name").alias("country_name"),
        F.inline(entries),
        F.lit("orders").alias("source"),
    ).where(F.col("value").isNotNull())


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as departments, with a text code that keeps its leading zero."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("dane_code"),
        F.col("n_name").alias("department"),
        F.concat(F.lit("Capital "), F.col("n_nationkey").cast("string")).alias("capital"),
        F.col("r_name").alias("region"),
    )


def indicator_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service answers as text, one per country and indicator: `[metadata, [records]]`.

    The service's ids have two letters and its names of indicators are long, so both differ from what was asked for
    (`country_code`, `indicator_code`). Besides the real records each answer has one of the year 1900 without a value,
    and each country an answer `[{}, null]` to an indicator that is not in the catalogue. A group holds one record per
    year, so its list is short.
    """
    long_name = F.concat(F.lit("International tourism, "), F.col("indicator_name"))

    def record(year: Column, value: Column) -> Column:
        return F.struct(
            F.struct(F.lower("indicator_code").alias("id"), long_name.alias("value")).alias("indicator"),
            F.struct(F.substring("country_code", 2, 2).alias("id"), F.col("country_name").alias("value")).alias("country"),
            year.cast("string").alias("date"),
            value.alias("value"),
        )

    grouped = regional(spark, sf_dir).groupBy("country_code", "indicator_code").agg(
        F.collect_list(record(F.col("year"), F.col("value"))).alias("given"),
        F.first(record(F.lit(1900), F.lit(None).cast("double"))).alias("gap"),
    )
    records = F.to_json(F.array_append("given", F.col("gap")), {"ignoreNullFields": "false"})
    answers = grouped.select(
        "country_code", "indicator_code", F.concat(F.lit('[{"page":1,"pages":1},'), records, F.lit("]")).alias("payload")
    )
    nothing = grouped.select("country_code", F.lit("XX.NONE").alias("indicator_code"), F.lit("[{}, null]").alias("payload"))
    return answers.unionAll(nothing.distinct())
