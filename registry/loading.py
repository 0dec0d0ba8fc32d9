"""Loads: the given tables are written as messy files to the shared scratch folder and read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estratos.functions import lenient_double, lenient_int, title_case
from estratos.operators import conform
from estratos.operators.quality import require_rows
from estratos.plans import bindings, bronze, gold, reports
from estratos.schemas import BRONZE
from estratos.session import scratch_path
from estratos.sources import readers, sinks
from estratos.streaming import landing
from registry import tables as t
from registry.base import register
from registry.oracles import big, rnd, sql, tc, whole


def land(df: DataFrame, path: str, encoding: str = "UTF-8", mode: str = "overwrite") -> str:
    """Write CSV with header, keeping outer spaces."""
    options = {"header": True, "encoding": encoding, "quote": '"', "escape": '"'}
    options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(**options).csv(path)
    return path


def landed(spark: SparkSession, df: DataFrame, label: str, encoding: str = "UTF-8") -> str:
    return land(df, scratch_path(spark, label), encoding)


def _text(name: str):
    return F.col(name).cast("string")


# --- B1, B2: several files with different headers ---------------------------------------------------

_ARRIVAL_COLUMNS = BRONZE["arrivals"].names


@register(
    "bronze_arrivals_files", "B1 IO1 SO1 PF1",
    sql(f"select {', '.join(_ARRIVAL_COLUMNS)} from arrivals", "arrivals"),
)
def _bronze_arrivals_files(spark, sf):
    """Two drops with headers in another order, one of them in Spanish with an extra column."""
    arrivals = bindings.arrivals(spark, sf)
    folder = scratch_path(spark, "drop")
    land(arrivals.where(F.col("year") < 1998), f"{folder}/arrivals_old.csv")
    land(
        arrivals.where(F.col("year") >= 1998).select(
            F.lit("x").alias("nota"), F.col("country_of_origin").alias("Pais-Origen"),
            F.col("month").alias("mes"), F.col("year").alias("año"),
            F.col("estimated_spending_usd").alias("gasto usd"), F.col("number_of_visitors").alias("llegadas"),
            F.col("destination_department").alias("DEPARTAMENTO"), F.col("travel_purpose").alias("motivo"),
            F.col("entry_point").alias("via"), F.col("arrival_date").alias("fecha_llegada"),
        ),
        f"{folder}/llegadas_new.csv",
    )
    loaded = bronze.arrivals_files(spark, folder)
    return loaded.select(_ARRIVAL_COLUMNS)


@register(
    "bronze_occupancy_files", "B2 IO1 PF1",
    sql(
        f"""select year, month, department, occupancy_rate * 2 - 50 as occupancy_rate,
                   case when l <> 'N' then {big('round_even(available_rooms + cast(0.5 as double), 0)')}
                       end as available_rooms,
                   cast(null as bigint) as occupied_rooms, average_rate_cop
            from (select *, trim(department)[6:] as l from occupancy)""",
        "occupancy",
    ),
)
def _bronze_occupancy_files(spark, sf):
    """Gaps, unreadable numbers and rates outside 0..100 stay for the cleaned table; halves are rounded to even."""
    rooms = F.concat(_text("available_rooms"), F.lit(".5"))
    occupancy = bindings.occupancy(spark, sf).withColumns(
        {
            "occupancy_rate": F.col("occupancy_rate") * 2 - 50, "occupied_rooms": F.lit(None).cast("string"),
            "available_rooms": F.when(F.col("department").contains("N"), F.lit("s/d")).otherwise(rooms),
        }
    )
    folder = scratch_path(spark, "drop")
    land(occupancy.where(F.col("year") < 1998), f"{folder}/hotel_occupancy.csv")
    land(
        occupancy.where(F.col("year") >= 1998).select(
            F.col("occupancy_rate").alias("Tasa Ocupacion"), F.col("year").alias("vigencia"),
            F.col("month").alias("mes"), F.col("department").alias("region"),
            F.col("average_rate_cop").alias("adr"), F.col("available_rooms").alias("cuartos-disponibles"),
        ),
        f"{folder}/ocupacion_nueva.csv",
    )
    return bronze.occupancy_files(spark, folder).select(BRONZE["occupancy"].names)


_CLAMPED = "cast(least(greatest(coalesce(occupancy_rate * 2 - 50, 50), 0), 100) as double)"


@register(
    "occupied_rooms_derived", "B5 PF3 PF6 PF7",
    sql(
        f"""select year, month, department, {_CLAMPED} as occupancy_rate, available_rooms,
                   {big(f'trunc(available_rooms * {_CLAMPED} / 100)')} as occupied_rooms, average_rate_cop
            from occupancy""",
        "occupancy",
    ),
)
def _occupied_rooms_derived(spark, sf):
    """Rates outside 0..100 and missing; the rooms column is there but never filled, so it is derived."""
    raw = bindings.occupancy(spark, sf).withColumns(
        {"occupancy_rate": F.col("occupancy_rate") * 2 - 50, "occupied_rooms": F.lit(None).cast("string")}
    )
    return bronze.occupancy_csv(raw, min_year=1990).select(BRONZE["occupancy"].names)


# --- B3, B6: indicator answers ----------------------------------------------------------------------

_INDICATORS = (
    "select year, indicator_code, indicator_name, value, country_code, country_name, 'world_bank' as source "
    "from regional"
)


@register(
    "indicator_payloads", "IO5",
    sql(_INDICATORS, "regional"),
)
def _indicator_payloads(spark, sf):
    """Parsing alone: answers with the service's own ids and names, a record without value, and `[{}, null]`."""
    answers = bindings.indicator_payloads(spark, sf)
    return readers.parse_indicator_payloads(answers, code="indicator_code", country_code="country_code")


def _answer_files(spark, sf):
    """One landed file per answer."""
    path = scratch_path(spark, "answers")
    answers = bindings.indicator_payloads(spark, sf)
    answers.write.partitionBy("country_code", "indicator_code").text(path)
    return f"{path}/*/*/*.txt"


@register(
    "bronze_indicators", "B3 IO5 PF12",
    sql(_INDICATORS, "regional"),
)
def _bronze_indicators(spark, sf):
    return bronze.indicator_files(spark, _answer_files(spark, sf), min_year=1995)


@register("bronze_regional", "B6 IO5 PF12", sql(_INDICATORS + " where year >= 1996", "regional"))
def _bronze_regional(spark, sf):
    return bronze.indicator_files(spark, _answer_files(spark, sf), min_year=1996)


@register(
    "latest_indicator", "IO21 WF4",
    sql(
        """select year, value from regional where indicator_code = 'ST.INT.ARVL'
           order by year desc, value desc limit 1""",
        "regional",
    ),
)
def _latest_indicator(spark, sf):
    return bronze.latest_indicator(bindings.regional(spark, sf))


@register(
    "event_props", "IO5",
    """select event_id, cast(json_extract(props, '$.k') as integer) as k from events""",
)
def _event_props(spark, sf):
    events = bindings.table(spark, sf, "events")
    return events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@register(
    "catalogue_names", "PF22",
    sql(
        """select country_code, indicator_code, count(*) as num_rows,
                  case indicator_code when 'ST.INT.ARVL' then 'international_arrivals'
                      when 'ST.INT.RCPT.CD' then 'tourism_receipts_current_usd'
                      when 'ST.INT.RCPT.XP.ZS' then 'tourism_pct_of_exports' end as name,
                  cast(null as varchar) as country
           from regional group by 1, 2""",
        "regional",
    ),
)
def _catalogue_names(spark, sf):
    named = conform.with_country_name(
        conform.with_indicator_name(bindings.regional(spark, sf), alias="name"), alias="country"
    )
    return named.groupBy("country_code", "indicator_code", "name", "country").agg(
        F.count(F.lit(1)).alias("num_rows")
    )


# --- B4, B5, B7-B10: one CSV dataset each -----------------------------------------------------------


def _messy_arrivals(spark, sf):
    low, status, urgent = (
        F.col("travel_purpose") == "5-LOW", F.col("entry_point").isNull(), F.col("travel_purpose") == "1-URGENT"
    )
    visitors = _text("number_of_visitors")
    return bindings.arrivals(spark, sf).select(
        F.concat(_text("year"), F.lit(".0")).alias("Año"), F.concat(F.lit(" "), _text("month")).alias(" Mes "),
        F.col("country_of_origin").alias("País de residencia"),
        F.col("destination_department").alias("departamento-destino"),
        F.when(~low, visitors).alias("visitantes"),
        F.when(status, F.lit("abc")).otherwise(F.concat(visitors, F.lit(".9"))).alias("llegadas"),
        F.when(urgent, F.lit("N/A")).otherwise(_text("estimated_spending_usd")).alias("gasto_estimado_usd"),
        F.col("travel_purpose").alias("tipo_viaje"), F.lit("libre").alias("observaciones"),
    )


@register(
    "bronze_arrivals_csv", "B4 IO2 IO3 PF1 PF2 PF3 PF5 PF12",
    sql(
        """select make_date(year, month, 15) as arrival_date, year, month, country_of_origin,
                  destination_department, travel_purpose, 'Aéreo' as entry_point,
                  case when travel_purpose = '5-LOW' and entry_point is null then 0
                       else number_of_visitors end as number_of_visitors,
                  case when travel_purpose = '1-URGENT' then 0 else estimated_spending_usd end
                      as estimated_spending_usd
           from arrivals where year >= 1996""",
        "arrivals",
    ),
)
def _bronze_arrivals_csv(spark, sf):
    """Two headers for one target, numbers as text, missing words, no date and no entry point, latin-1."""
    path = landed(spark, _messy_arrivals(spark, sf), "arrivals", "ISO-8859-1")
    raw = readers.read_csv(spark, path, encoding="ISO-8859-1")
    return bronze.arrivals_csv(raw, min_year=1996).select(_ARRIVAL_COLUMNS)


@register(
    "arrivals_from_dates", "PF2 PF4",
    f"""select cast(o_orderdate as date) as arrival_date, {whole('year(o_orderdate)')} as year,
               {whole('month(o_orderdate)')} as month, 'Desconocido' as country_of_origin,
               'Desconocido' as destination_department, 'Turismo' as travel_purpose, 'Aéreo' as entry_point,
               cast(0 as bigint) as number_of_visitors, o_totalprice as estimated_spending_usd
        from orders where o_orderpriority <> '3-MEDIUM'""",
)
def _arrivals_from_dates(spark, sf):
    """Only a date text and spending: the rest is derived or defaulted, rows without a readable date go."""
    orders = bindings.table(spark, sf, "orders")
    text = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("sin fecha")).otherwise(_text("o_orderdate"))
    raw = orders.select(text.alias("fecha_llegada"), _text("o_totalprice").alias("spending"))
    return bronze.arrivals_csv(raw, min_year=1990).select(_ARRIVAL_COLUMNS)


@register(
    "arrivals_without_dates", "PF5",
    sql(
        """select make_date(year, month, 15) as arrival_date, year, month, count(*) as num_rows
           from arrivals group by all""",
        "arrivals",
    ),
)
def _arrivals_without_dates(spark, sf):
    """The date column is there but never filled."""
    raw = bindings.arrivals(spark, sf).withColumn("arrival_date", F.lit(None).cast("string"))
    loaded = bronze.arrivals_csv(raw, min_year=1990)
    return loaded.groupBy("arrival_date", "year", "month").agg(F.count(F.lit(1)).alias("num_rows"))


@register(
    "bronze_occupancy_csv", "B5 IO3 PF1 PF2 PF3 PF6 PF7 PF12",
    sql(
        """select year, month, department, cast(coalesce(occupancy_rate, 50) as double) as occupancy_rate,
                  available_rooms, coalesce(occupied_rooms, 0) as occupied_rooms,
                  cast(0 as double) as average_rate_cop
           from occupancy where year >= 1996""",
        "occupancy",
    ),
)
def _bronze_occupancy_csv(spark, sf):
    """Rooms partly filled stay as given; the price column is missing."""
    raw = bindings.occupancy(spark, sf).select(
        F.col("year").alias("anio"), F.col("month").alias("mes"), F.col("department").alias("departamento"),
        F.col("occupancy_rate").alias("porcentaje-ocupacion"),
        F.col("available_rooms").alias("habitaciones disponibles"),
        F.col("occupied_rooms").alias("habitaciones_vendidas"),
    )
    read = readers.read_csv(spark, landed(spark, raw, "occupancy"))
    return bronze.occupancy_csv(read, min_year=1996).select(BRONZE["occupancy"].names)


@register(
    "bronze_gdp_csv", "B7 IO3 PF2",
    sql(
        """select year, tourism_gdp_billions_cop, pct_of_total_gdp, tourism_employment_thousands,
                  annual_variation_pct, 'dane' as source from gdp""",
        "gdp",
    ),
)
def _bronze_gdp_csv(spark, sf):
    read = readers.read_csv(spark, landed(spark, bindings.gdp(spark, sf).drop("source"), "gdp"))
    return bronze.gdp_csv(read).select(BRONZE["gdp"].names)


@register(
    "bronze_migration_csv", "B8 IO3 PF2",
    sql(
        f"""select year, month, nationality, movement_type, control_point,
                   {big('number_of_travelers')} as number_of_travelers, cast(null as varchar) as source
            from migration""",
        "migration",
    ),
)
def _bronze_migration_csv(spark, sf):
    """The source column is there and empty, so it stays null."""
    read = readers.read_csv(spark, landed(spark, bindings.migration(spark, sf), "migration"))
    return bronze.migration_csv(read).select(BRONZE["migration"].names)


_AIR = """select year, month, airport, 'Desconocido' as airport_city,
    coalesce(cast(domestic_passengers as bigint), 0) as domestic_passengers,
    coalesce(cast(international_passengers as bigint), 0) as international_passengers,
    coalesce(cast(domestic_passengers as bigint), 0) + coalesce(cast(international_passengers as bigint), 0)
        as total_passengers from air where year >= 1996"""


def _air_raw(spark, sf, total):
    return bindings.air(spark, sf).select(
        F.col("year").alias("año"), F.col("month").alias("mes"), F.col("airport").alias("Aeropuerto"),
        F.col("domestic_passengers").alias("pasajeros nacionales"),
        F.col("international_passengers").alias("pasajeros-internacionales"), total.alias("total_pasajeros"),
    )


@register("bronze_air_csv", "B9 IO3 PF1 PF2 PF3 PF8 PF12", sql(_AIR, "air"))
def _bronze_air_csv(spark, sf):
    """The totals sum to zero and are derived."""
    read = readers.read_csv(spark, landed(spark, _air_raw(spark, sf, F.lit("0")), "air"))
    return bronze.air_csv(read, min_year=1996).select(BRONZE["air"].names)


@register(
    "air_totals_kept", "PF8",
    sql(
        """select year, month, airport, coalesce(cast(total_passengers as bigint), 0) + 1 as total_passengers
           from air""",
        "air",
    ),
)
def _air_totals_kept(spark, sf):
    """Totals that are filled stay as they are, even where the parts add up to something else."""
    loaded = bronze.air_csv(_air_raw(spark, sf, F.col("total_passengers") + 1), min_year=1990)
    return loaded.select("year", "month", "airport", "total_passengers")


@register(
    "bronze_balance_csv", "B10 IO3 PF1 PF3 PF9 PF12",
    sql(
        """select year, quarter, coalesce(tourism_income_usd_millions, 0) as tourism_income_usd_millions,
                  coalesce(tourism_expenditure_usd_millions, 0) as tourism_expenditure_usd_millions,
                  coalesce(tourism_income_usd_millions, 0) - coalesce(tourism_expenditure_usd_millions, 0)
                      as tourism_balance_usd_millions, 'banrep' as source
           from balance where year >= 1996""",
        "balance",
    ),
)
def _bronze_balance_csv(spark, sf):
    raw = bindings.balance(spark, sf).select(
        F.col("year").alias("Año"), F.col("quarter").alias("Trimestre"),
        F.col("tourism_income_usd_millions").alias("Ingresos Turismo USD"),
        F.col("tourism_expenditure_usd_millions").alias("egresos"),
    )
    read = readers.read_csv(spark, landed(spark, raw, "balance"))
    return bronze.balance_csv(read, min_year=1996).select(BRONZE["balance"].names)


@register(
    "lenient_numbers", "PF3",
    """select o_orderkey,
              case o_orderpriority when '1-URGENT' then 7 when '2-HIGH' then 7 when '3-MEDIUM' then 7
                  else cast(trunc(o_totalprice) as integer) end as whole_value,
              case o_orderpriority when '1-URGENT' then 50 when '2-HIGH' then 50 when '3-MEDIUM' then 50
                  else o_totalprice end as value
       from orders""",
)
def _lenient_numbers(spark, sf):
    """Number texts, some unreadable, empty, or with thousands separators."""
    price = _text("o_totalprice")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("n/d"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit(""))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("1,"), price))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit(" "), price, F.lit(" ")))
        .otherwise(price)
    )
    return bindings.table(spark, sf, "orders").select(
        "o_orderkey", lenient_int(text, 7).alias("whole_value"), lenient_double(text, 50.0).alias("value")
    )


# --- Source choice, archive, tables -----------------------------------------------------------------


@register(
    "source_choice", "IO16",
    """select 'filled' as landing, 'landed' as source_used, count(*) as num_rows from orders
       union all select 'empty', 'fallback', count(*) from orders
       union all select 'missing', 'fallback', count(*) from orders
       union all select 'unreadable', 'fallback', count(*) from orders
       union all select 'two headers', 'fallback', count(*) from orders
       union all select 'unset', 'fallback', count(*) from orders""",
)
def _source_choice(spark, sf):
    orders = bindings.table(spark, sf, "orders")
    missing, mixed, broken = (scratch_path(spark, name) for name in ("nothing-here", "mixed", "broken"))
    land(orders.select("o_orderkey", "o_orderpriority").where("o_orderkey % 2 = 0"), f"{mixed}/a")
    land(orders.select("o_orderpriority", "o_orderkey").where("o_orderkey % 2 = 1"), f"{mixed}/b")
    orders.select(_text("o_orderkey")).write.text(broken)
    schema = "o_orderkey string, o_orderpriority string"
    cases = {
        "filled": lambda: orders,
        "empty": lambda: orders.where(F.col("o_totalprice") < 0),
        "missing": lambda: readers.read_csv(spark, missing),
        "unreadable": lambda: spark.read.schema(schema).option("pathGlobFilter", "*.txt").parquet(broken),
        "two headers": lambda: spark.read.schema(schema).options(**readers.csv_options()).csv(f"{mixed}/b"),
        "unset": None,
    }
    parts = []
    for name, primary in cases.items():
        chosen = readers.read_or_else(primary, lambda: orders, "landed", "fallback")
        counted = chosen.groupBy("source_used").agg(F.count(F.lit(1)).alias("num_rows"))
        parts.append(counted.select(F.lit(name).alias("landing"), "source_used", "num_rows"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@register(
    "csv_text_fidelity", "IO2 IO3 IO19",
    f"""select 'caf' || chr(233) || ', "' || n_name || '" ' || o_orderpriority as phrase, count(*) as num_rows
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1""",
)
def _csv_text_fidelity(spark, sf):
    """Commas, quotes and accents through a latin-1 file."""
    orders = bindings.orders_by_nation(spark, sf)
    phrase = F.concat(F.lit('café, "'), "n_name", F.lit('" '), "o_orderpriority")
    path = landed(spark, orders.select(phrase.alias("phrase")), "phrases", "ISO-8859-1")
    return readers.read_csv(spark, path, encoding="ISO-8859-1").groupBy("phrase").agg(
        F.count(F.lit(1)).alias("num_rows")
    )


@register(
    "archived_lines", "IO4",
    f"""select count(*) as num_lines, {big('sum(o_orderkey)')} as key_sum from orders""",
)
def _archived_lines(spark, sf):
    """The dated copy of landed text, read back as lines."""
    lines = bindings.table(spark, sf, "orders").select(F.concat_ws("|", _text("o_orderkey"), "o_orderpriority"))
    path, archive = scratch_path(spark, "lines"), scratch_path(spark, "archive")
    lines.write.text(path)
    sinks.archive_lines(spark, path, archive, "orders", date(2024, 5, 1))
    kept = spark.read.schema("path string, block bigint, value string").parquet(
        f"{archive}/orders/ingest_date=2024-05-01"
    )
    return kept.agg(
        F.count(F.lit(1)).alias("num_lines"),
        F.sum(F.split_part("value", F.lit("|"), F.lit(1)).cast("bigint")).alias("key_sum"),
    )


@register(
    "archived_payloads", "IO4 IO5",
    sql(
        """select country_code[2:] as country_code, lower(indicator_code) as indicator_code, count(*) as num_rows
           from regional group by 1, 2""",
        "regional",
    ),
)
def _archived_payloads(spark, sf):
    """The dated copy of answer files keeps their bytes: parsing the copy gives the records, with their own ids."""
    archive = scratch_path(spark, "archive")
    sinks.archive_payloads(spark, _answer_files(spark, sf), archive, "answers", date(2024, 5, 1))
    kept = spark.read.schema("path string, length bigint, content binary").parquet(
        f"{archive}/answers/ingest_date=2024-05-01"
    )
    rows = readers.parse_indicator_payloads(kept.select(F.decode("content", "UTF-8").alias("payload")))
    return rows.groupBy("country_code", "indicator_code").agg(F.count(F.lit(1)).alias("num_rows"))


@register(
    "parquet_by_year", "IO6 IO7 IO21",
    sql(
        f"""select year, count(*) as num_rows, {big('sum(number_of_travelers)')} as travelers,
                   (select count(*) from fct_migration_flows) as rows_written
            from fct_migration_flows group by 1""",
        "fct_migration_flows",
    ),
)
def _parquet_by_year(spark, sf):
    """Written by year, with the row count measured in the write."""
    fact = t.migration(spark, sf)
    path = scratch_path(spark, "flows")
    metrics = sinks.write_parquet(fact, path, ["year"])
    return readers.read_table(spark, path, fact.schema).groupBy("year").agg(
        F.count(F.lit(1)).alias("num_rows"), F.sum("number_of_travelers").alias("travelers"),
        F.lit(metrics["num_rows"]).cast("bigint").alias("rows_written"),
    )


@register(
    "table_and_export", "IO8 IO9 IO14",
    f"""select o_orderstatus, count(*) as num_rows, {big('sum(o_orderkey)')} as key_sum,
               (select count(*) from orders) as rows_loaded
        from orders group by 1""",
)
def _table_and_export(spark, sf):
    """A catalogue table, its export to Parquet, and SQL over a view of the export."""
    path = scratch_path(spark, "table")
    name = "estratos_" + path.rsplit("-", 1)[1]
    rows = sinks.save_as_table(bindings.table(spark, sf, "orders"), name, f"{path}/table")
    sinks.export_table(spark, name, f"{path}/export")
    spark.sql(f"drop table {name}")
    exported = spark.read.schema(bindings.TABLES["orders"]).parquet(f"{path}/export")
    sinks.publish_view(exported, f"{name}_view")
    out = spark.sql(
        f"select o_orderstatus, count(*) as num_rows, sum(o_orderkey) as key_sum, "
        f"cast({rows} as bigint) as rows_loaded from {name}_view group by o_orderstatus"
    )
    spark.catalog.dropTempView(f"{name}_view")
    return out


@register(
    "seed_departments", "IO11 M17",
    sql("select * from departments", "departments"),
)
def _seed_departments(spark, sf):
    """The seed has its columns in another order, and one more."""
    mixed = bindings.departments(spark, sf).select("region", F.lit("x").alias("nota"), "department", "dane_code", "capital")
    seed = readers.read_seed(spark, landed(spark, mixed, "seed"))
    return gold.dim_departments(seed, None)


@register(
    "sorted_indicators", "IO20",
    sql("select * from regional", "regional"),
)
def _sorted_indicators(spark, sf):
    path = scratch_path(spark, "sorted")
    df = bindings.regional(spark, sf)
    sinks.write_sorted(df, path, ["country_code", "indicator_code", "year"])
    return readers.read_table(spark, path, df.schema)


# --- Q29: downloads ---------------------------------------------------------------------------------


def _export(table: str):
    def run(spark, sf):
        fact = t.FACTS[table](spark, sf)
        path = scratch_path(spark, f"export-{table}")
        sinks.export_csv(reports.export_rows(table, fact, (1995, 2001)), path)
        # Another null word than '' lets quoted empty texts be told from missing ones.
        options = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8", "nullValue": "\u0001"}
        read = spark.read.schema(fact.schema).options(**options).csv(path)
        return t.rounded(read, 6, *[c for c in read.columns if c.startswith("ytd_")])

    return run


def _export_oracle(table: str) -> str:
    if table == "dim_departments":
        return sql("select * from departments", "departments")
    columns = "*"
    if table == "fct_tourism_balance":
        columns = (
            f"* replace ({rnd('ytd_income', 6)} as ytd_income, {rnd('ytd_expenditure', 6)} as ytd_expenditure)"
        )
    return sql(f"select {columns} from {table} where year between 1995 and 2001", table)


for _table in reports.EXPORT_ORDER:
    register(f"export_{_table}", "Q29 IO10 SL3 PF13", _export_oracle(_table), _export(_table))


# --- ST1: new files ---------------------------------------------------------------------------------

_EVENT_COLUMNS = ["event_id", "day", "event_type", "value", "props"]


def _events_text(spark, sf):
    return bindings.table(spark, sf, "events").select(
        _text("event_id").alias("event_id"), _text("ts").alias("day"),
        F.concat(F.lit("  "), F.upper("event_type")).alias("event_type"), _text("value").alias("value"), "props",
    )


def _clean_events(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("event_id").cast("bigint").alias("event_id"), F.col("day").cast("date").alias("event_date"),
        title_case("event_type").alias("event_type"), lenient_double("value", 0.0).alias("value"),
        F.from_json("props", "k int")["k"].alias("k"),
    )


@register(
    "new_files_stream", "ST1",
    f"""select event_id, cast(ts as date) as event_date, {tc('event_type')} as event_type, value,
               cast(json_extract(props, '$.k') as integer) as k,
               (select count(*) from events where ts < cast('2024-01-16' as timestamp)) as first_run,
               cast(0 as bigint) as second_run,
               (select count(*) from events where ts >= cast('2024-01-16' as timestamp)) as third_run
        from events""",
)
def _new_files_stream(spark, sf):
    """Half of the days land, one run; nothing new, one run; the rest lands, one run. No row twice."""
    root = scratch_path(spark, "stream")
    events = _events_text(spark, sf)
    early = F.col("day") < "2024-01-16"
    load = lambda: landing.load_new_files(
        spark, f"{root}/landing", _EVENT_COLUMNS, _clean_events, f"{root}/sink", f"{root}/checkpoint"
    )
    land(events.where(early), f"{root}/landing")
    first = load()
    second = load()
    land(events.where(~early), f"{root}/landing", mode="append")
    third = load()
    runs = {"first_run": first, "second_run": second, "third_run": third}
    schema = T.StructType.fromDDL("event_id bigint, event_date date, event_type string, value double, k int")
    out = landing.loaded_rows(spark, f"{root}/sink", schema)
    return out.withColumns({name: F.lit(n).cast("bigint") for name, n in runs.items()})


@register(
    "new_arrivals_stream", "ST1 PF1 PF3",
    sql(
        f"""select year, month, count(*) as num_rows, {big('sum(number_of_visitors)')} as visitors
            from arrivals group by 1, 2""",
        "arrivals",
    ),
)
def _new_arrivals_stream(spark, sf):
    """Arrivals files conformed as they land."""
    root = scratch_path(spark, "stream")
    raw = bindings.arrivals(spark, sf).select(
        F.col("year").alias("anio"), F.col("month").alias("mes"), F.col("country_of_origin").alias("pais"),
        F.col("number_of_visitors").alias("llegadas"), F.col("arrival_date").alias("fecha_llegada"),
    )
    land(raw, f"{root}/landing")
    landing.load_new_files(
        spark, f"{root}/landing", raw.columns, lambda rows: bronze.arrivals_csv(rows, min_year=1990),
        f"{root}/sink", f"{root}/checkpoint", partition_by=["year"],
    )
    out = landing.loaded_rows(spark, f"{root}/sink", BRONZE["arrivals"])
    return out.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("num_rows"), F.sum("number_of_visitors").alias("visitors")
    )


_LANDED_ALIKE = """
select 'batch' as way, * from rows union all select 'stream' as way, * from rows"""


@register(
    "stream_equals_batch", "ST1 PF5 PF7 PF8",
    "with rows as (" + sql(
        """select 'arrivals' as landed, year, month, make_date(year, month, 15) as arrival_date,
                  cast(count(*) as bigint) as num_rows, cast(null as bigint) as derived
           from arrivals group by all
           union all
           select 'air', year, month, null, cast(count(*) as bigint),
                  cast(sum(coalesce(cast(domestic_passengers as bigint), 0)
                           + coalesce(cast(international_passengers as bigint), 0)) as bigint)
           from air group by all
           union all
           select 'occupancy', year, month, null, cast(count(*) as bigint),
                  cast(sum(cast(trunc(available_rooms * coalesce(occupancy_rate, 50) / 100) as bigint)) as bigint)
           from occupancy group by all""",
        "arrivals", "air", "occupancy",
    ) + ")" + _LANDED_ALIKE,
)
def _stream_equals_batch(spark, sf):
    """One set of files, loaded by batch and as it lands: dates and rooms never filled, totals that sum to zero."""
    nothing = F.lit(None).cast("string")
    sets = {
        "arrivals": (bindings.arrivals(spark, sf).withColumn("arrival_date", nothing), bronze.arrivals_csv, None),
        "air": (bindings.air(spark, sf).withColumn("total_passengers", F.lit(0)), bronze.air_csv, "total_passengers"),
        "occupancy": (
            bindings.occupancy(spark, sf).withColumn("occupied_rooms", nothing), bronze.occupancy_csv, "occupied_rooms",
        ),
    }
    parts = []
    for name, (raw, conformed, derived) in sets.items():
        root = scratch_path(spark, f"alike-{name}")
        land(raw, f"{root}/in")
        for _ in range(2):  # a repeated run adds nothing
            landing.load_new_files(
                spark, f"{root}/in", raw.columns, lambda rows, c=conformed: c(rows, min_year=1990), f"{root}/out", f"{root}/check"
            )
        ways = {
            "batch": conformed(readers.read_csv(spark, f"{root}/in"), min_year=1990),
            "stream": landing.loaded_rows(spark, f"{root}/out", BRONZE[name]),
        }
        for way, rows in ways.items():
            day = F.col("arrival_date").cast("date") if "arrival_date" in rows.columns else F.lit(None).cast("date")
            total = F.sum(derived) if derived else F.max(F.lit(None).cast("bigint"))
            parts.append(
                rows.groupBy("year", "month", day.alias("arrival_date")).agg(
                    F.count(F.lit(1)).alias("num_rows"), total.alias("derived")
                ).select(F.lit(way).alias("way"), F.lit(name).alias("landed"), "*")
            )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@register(
    "mixed_date_texts", "PF4",
    f"""select cast(o_orderdate as date) as arrival_date, {whole('year(o_orderdate)')} as year,
               {whole('month(o_orderdate)')} as month, cast(count(*) as bigint) as num_rows
        from orders where o_orderkey % 7 <> 6 group by all""",
)
def _mixed_date_texts(spark, sf):
    """Order dates as texts of six kinds; a seventh of the texts is no date. Days up to 12 stand after the month."""
    orders, kind = bindings.table(spark, sf, "orders"), F.col("o_orderkey") % 7
    patterns = ["yyyy-MM-dd", "yyyyMMdd", "yyyy/MM/dd", "MM/dd/yyyy", "MMMM d, yyyy", "d MMM yyyy"]
    text = F.lit("s/f")
    for number, pattern in enumerate(patterns):
        text = F.when(kind == number, F.date_format("o_orderdate", pattern)).otherwise(text)
    loaded = bronze.arrivals_csv(orders.select(text.alias("fecha_llegada")), min_year=1990)
    return loaded.groupBy("arrival_date", "year", "month").agg(F.count(F.lit(1)).alias("num_rows"))


_ORDERED = """select '{0}' as landed, cast(o_orderdate as date) as arrival_date, cast(count(*) as bigint) as num_rows,
               '{0} first' as date_order from orders group by all"""


@register("date_order_of_a_column", "PF4 B4 IO21", _ORDERED.format("day") + " union all " + _ORDERED.format("month"))
def _date_order_of_a_column(spark, sf):
    """One file with the day first and one with the month first: days below 13 are read like the other rows of their file."""
    orders, parts = bindings.table(spark, sf, "orders"), []
    for name, pattern in (("day", "dd/MM/yyyy"), ("month", "M/d/yyyy")):
        root = scratch_path(spark, "date-order")
        land(orders.select(F.date_format("o_orderdate", pattern).alias("fecha_llegada")), f"{root}/in")
        report = bronze.load(spark, "arrivals", f"{root}/in", bindings.arrivals(spark, sf), f"{root}/out", min_year=1990)
        rows = readers.read_table(spark, f"{root}/out", BRONZE["arrivals"])
        rows = rows.groupBy(F.col("arrival_date").cast("date").alias("arrival_date")).agg(F.count(F.lit(1)).alias("num_rows"))
        parts.append(rows.select(F.lit(name).alias("landed"), "*", F.lit(report.date_order).alias("date_order")))
    return parts[0].unionByName(parts[1])


@register(
    "quoted_line_breaks", "IO3",
    f"""select 'whole' as way, o_orderpriority || chr(10) || 'x' as country_of_origin, cast(count(*) as bigint) as num_rows,
               cast(sum(o_orderkey) as bigint) as visitors, cast(0 as bigint) as rows_broken
        from orders group by all
        union all
        select 'lines', o_orderpriority, cast(count(*) as bigint), cast(sum(o_orderkey) as bigint),
               (select cast(2 * count(*) as bigint) from orders where o_orderkey % 4 = 0)
        from orders where o_orderkey % 4 <> 0 group by all""",
)
def _quoted_line_breaks(spark, sf):
    """Cells with line breaks through a whole load: kept; where the caller said there are none, left out and counted."""
    orders = bindings.table(spark, sf, "orders")
    fallback = bindings.arrivals(spark, sf)
    parts = []
    for way, cell in (
        ("whole", F.concat("o_orderpriority", F.lit("\nx"))),
        ("lines", F.when(F.col("o_orderkey") % 4 == 0, F.concat("o_orderpriority", F.lit("\nx"))).otherwise(F.col("o_orderpriority"))),
    ):
        raw = orders.select(
            F.year("o_orderdate").alias("anio"), cell.alias("pais"), F.month("o_orderdate").alias("mes"),
            F.col("o_orderkey").alias("llegadas"),
        )
        root = scratch_path(spark, "breaks")
        land(raw, f"{root}/in")
        report = bronze.load(
            spark, "arrivals", f"{root}/in", fallback, f"{root}/out", min_year=1990, multiline=way == "whole"
        )
        rows = readers.read_table(spark, f"{root}/out", BRONZE["arrivals"])
        parts.append(rows.groupBy("country_of_origin").agg(
            F.count(F.lit(1)).alias("num_rows"), F.sum("number_of_visitors").alias("visitors"),
        ).select(F.lit(way).alias("way"), "*", F.lit(report.rows_broken).cast("bigint").alias("rows_broken")))
    return parts[0].unionByName(parts[1])


_FIRST, _MIDDLE, _LAST = "o_orderpriority || chr(10) || chr(10) || 'x'", "'a \"b\",' || chr(10) || 'c' || chr(10) || o_orderstatus", "'p' || chr(10)"


@register(
    "line_breaks_in_any_cell", "IO3 B1 B4 ST1",
    f"""with rows as (
          select {_FIRST} as country_of_origin, {_MIDDLE} as entry_point, {_LAST} as travel_purpose,
                 cast(count(*) as bigint) as num_rows, cast(sum(o_orderkey) as bigint) as visitors
          from orders group by all)
        select 'load' as way, * from rows union all select 'drop', * from rows union all select 'stream', * from rows""",
)
def _line_breaks_in_any_cell(spark, sf):
    """Cells of two and three lines in the first, a middle and the last column, by a load, a drop folder and a stream."""
    orders = bindings.table(spark, sf, "orders")
    raw = orders.select(
        F.concat("o_orderpriority", F.lit("\n\nx")).alias("pais"), F.year("o_orderdate").alias("anio"),
        F.concat(F.lit('a "b",\nc\n'), "o_orderstatus").alias("via"), F.month("o_orderdate").alias("mes"),
        F.col("o_orderkey").alias("llegadas"), F.lit("p\n").alias("motivo"),
    )
    root = scratch_path(spark, "any-cell")
    land(raw, f"{root}/arrivals.csv")
    bronze.load(spark, "arrivals", f"{root}/arrivals.csv", bindings.arrivals(spark, sf), f"{root}/out", min_year=1990)
    landing.load_new_files(
        spark, f"{root}/arrivals.csv", raw.columns, lambda rows: bronze.arrivals_csv(rows, min_year=1990),
        f"{root}/sink", f"{root}/checkpoint",
    )
    ways = {
        "load": readers.read_table(spark, f"{root}/out", BRONZE["arrivals"]),
        "drop": bronze.arrivals_files(spark, root),
        "stream": landing.loaded_rows(spark, f"{root}/sink", BRONZE["arrivals"]),
    }
    parts = [
        rows.groupBy("country_of_origin", "entry_point", "travel_purpose").agg(
            F.count(F.lit(1)).alias("num_rows"), F.sum("number_of_visitors").alias("visitors")
        ).select(F.lit(way).alias("way"), "*")
        for way, rows in ways.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register(
    "load_report", "IO21 AG15 DQ7",
    sql(
        """select cast(count(*) as bigint) as num_rows, cast(min(year) as integer) as year_min,
                  cast(max(year) as integer) as year_max,
                  cast(count(distinct country_code) as bigint) as country_code_count,
                  cast(count(distinct indicator_code) as bigint) as indicator_code_count,
                  cast(max(year) as integer) as latest_year, cast(5 as bigint) as previewed
           from regional""",
        "regional",
    ),
)
def _load_report(spark, sf):
    """What a load of indicator answers reports, of a table that may not be empty."""
    path = scratch_path(spark, "reported")
    report = bronze.load_indicators(
        spark, "regional", _answer_files(spark, sf), bindings.regional(spark, sf), path, min_year=1900
    )
    require_rows(readers.read_table(spark, path, BRONZE["regional"]))
    return spark.createDataFrame(
        [(
            report.num_rows, report.year_min, report.year_max, report.distinct["country_code_count"],
            report.distinct["indicator_code_count"], report.latest["year"], len(report.preview),
        )],
        "num_rows bigint, year_min int, year_max int, country_code_count bigint, indicator_code_count bigint, "
        "latest_year int, previewed bigint",
    )


@register(
    "summary_of_loads", "IO21 AG15",
    sql(
        """select cast(2 * count(*) as bigint) as num_rows, cast(min(year) as integer) as year_min,
                  cast(max(year) as integer) as year_max,
                  cast(count(distinct country_code) as bigint) as country_code_count,
                  cast(count(distinct indicator_code) as bigint) as indicator_code_count
           from regional""",
        "regional",
    ),
)
def _summary_of_loads(spark, sf):
    """Two loads of the same answers: rows add up, and keys that both hold count once."""
    answers, fallback, kept = _answer_files(spark, sf), bindings.regional(spark, sf), scratch_path(spark, "summaries")
    for path in (scratch_path(spark, "loaded"), scratch_path(spark, "loaded-again")):
        bronze.load_indicators(spark, "regional", answers, fallback, path, min_year=1900, sketches=kept)
    found = bronze.summary_of_loads(spark, "regional", kept)
    return found.select("num_rows", "year_min", "year_max", "country_code_count", "indicator_code_count")
