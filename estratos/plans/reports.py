"""The analytical questions (Q1-Q29) over the gold tables.

Each takes the facts it needs, an optional (first, last) pair of years and optional dimension choices.
`order by` is part of the reports; every order ends in a key, so results are reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estratos import fixed_values as fixed
from estratos.functions import (
    exact_avg, exact_sum, month_short_name, period_label, period_text_date, scaled,
)
from estratos.operators import aggregates as agg
from estratos.operators import joins, statistics, topk, windows
from estratos.operators.filters import equal_unless_all, in_years, sorted_distinct

Years = tuple[int, int] | None


def _arrivals(fct: DataFrame, years: Years, department: str | None) -> DataFrame:
    return equal_unless_all(in_years(fct, years), "destination_department", department)


def arrival_years(fct_arrivals: DataFrame) -> DataFrame:
    """Q1, PF14."""
    return sorted_distinct(fct_arrivals, "year")


def arrival_departments(fct_arrivals: DataFrame) -> DataFrame:
    """Q2, PF14."""
    return sorted_distinct(fct_arrivals, "destination_department")


def occupancy_departments(fct_occupancy: DataFrame) -> DataFrame:
    """Q3, PF14."""
    return sorted_distinct(fct_occupancy, "department")


def headline_kpis(fct_arrivals: DataFrame, years: Years = None, department: str | None = None) -> DataFrame:
    """Q4, AG2, PF13."""
    rows = _arrivals(fct_arrivals, years, department)
    cents = F.col("total_spending_usd").cast("decimal(18, 2)")
    totals = agg.totals_with_distincts(
        rows.withColumn("total_spending_usd", cents),
        {"total_visitors": "total_visitors", "total_spending_usd": "total_spending_usd"},
        {"countries_of_origin": "country_of_origin", "departments": "destination_department"},
    )
    return totals.withColumn("total_spending_usd", F.round(F.col("total_spending_usd").cast("double"), 0))


def _arrivals_yearly(fct_arrivals: DataFrame, years: Years, department: str | None) -> DataFrame:
    return agg.total_by(
        _arrivals(fct_arrivals, years, department), ["year"], total_visitors="total_visitors",
        total_spending_usd=F.round(exact_sum("total_spending_usd", 2), 0),
    )


def arrivals_by_year(fct_arrivals: DataFrame, years: Years = None, department: str | None = None) -> DataFrame:
    """AG4. Yearly visitors and spending, without the growth column."""
    return _arrivals_yearly(fct_arrivals, years, department).orderBy("year")


def arrivals_growth(fct_arrivals: DataFrame, years: Years = None, department: str | None = None) -> DataFrame:
    """Q5, AG4, WF3. With growth against the previous year in percent; null in the first year and after a zero."""
    yearly = _arrivals_yearly(fct_arrivals, years, department)
    return windows.change_pct(yearly, "year", "total_visitors", "yoy_pct").orderBy("year")


def top_countries(
    fct_arrivals: DataFrame, years: Years = None, department: str | None = None, n: int = 10,
    spending: str = "avg_spending_usd",
) -> DataFrame:
    """Q6, SL1. The spending column is the mean of the fact rows' means, not weighted by visitors."""
    by_country = _arrivals(fct_arrivals, years, department).groupBy("country_of_origin").agg(
        F.sum("total_visitors").alias("total_visitors"),
        F.round(exact_avg("average_spending_usd", 2), 2).alias(spending),
    )
    return topk.top(by_country, n, "total_visitors", "country_of_origin")


def visitors_by_purpose(fct_arrivals: DataFrame, years: Years = None, department: str | None = None) -> DataFrame:
    """Q7, AG6."""
    return agg.ranked_totals(_arrivals(fct_arrivals, years, department), "travel_purpose", "total_visitors", "total")


def visitors_by_entry_point(
    fct_arrivals: DataFrame, years: Years = None, department: str | None = None
) -> DataFrame:
    """Q8, AG6."""
    return agg.ranked_totals(_arrivals(fct_arrivals, years, department), "entry_point", "total_visitors", "total")


def arrivals_seasonality(fct_arrivals: DataFrame, years: Years = None, department: str | None = None) -> DataFrame:
    """Q9, AG5, J3."""
    monthly = agg.total_by(
        _arrivals(fct_arrivals, years, department), ["month"], total_visitors="total_visitors"
    )
    return monthly.withColumn("month_name", month_short_name("month")).orderBy("month")


def department_coordinates(spark) -> DataFrame:
    """The fixed list of department coordinates."""
    rows = [(name, lat, lon) for name, (lat, lon) in fixed.DEPARTMENT_COORDINATES.items()]
    return spark.createDataFrame(rows, "department string, lat double, lon double")


def department_map(fct_arrivals: DataFrame, years: Years = None, fold_case: bool = True) -> DataFrame:
    """Q10, AG7, J2. Visitors per department with coordinates; unknown departments get the default point.

    Names are compared without regard to case; `fold_case=False` compares them exactly.
    """
    totals = agg.total_by(in_years(fct_arrivals, years), ["destination_department"], visitors="total_visitors")
    lat, lon = fixed.DEFAULT_COORDINATES
    return joins.lookup_or_default(
        totals.withColumnRenamed("destination_department", "dept"), "dept",
        department_coordinates(fct_arrivals.sparkSession), "department", {"lat": lat, "lon": lon},
        fold_case=fold_case, fixed_size=True,
    )


def occupancy_trend(fct_occupancy: DataFrame, years: Years = None, department: str | None = None) -> DataFrame:
    """Q11, AG8, PF19."""
    rows = equal_unless_all(in_years(fct_occupancy, years), "department", department)
    monthly = rows.groupBy("year", "month", "department").agg(
        F.round(F.avg("occupancy_rate"), 1).alias("avg_occupancy")
    )
    return topk.ordered(
        monthly.withColumn("fecha", period_text_date("year", "month")), ["year", "month", "department"]
    )


def _occupancy_by_department(fct_occupancy: DataFrame, years: Years) -> DataFrame:
    rate, price = F.avg("occupancy_rate"), exact_avg("average_rate_cop", 0)
    return in_years(fct_occupancy, years).groupBy("department").agg(
        F.round(rate, 1).alias("avg_occupancy"),
        F.round(price, 0).alias("avg_rate_cop"),
        F.sum("available_rooms").alias("total_rooms"),
        F.round(rate * price / 100, 0).alias("revpar_cop"),
    )


def occupancy_summary(fct_occupancy: DataFrame, years: Years = None) -> DataFrame:
    """Q12, AG9. Per department; revenue per available room is the product of the two averages."""
    by_department = _occupancy_by_department(fct_occupancy, years)
    return by_department.orderBy(F.col("avg_occupancy").desc(), "department")


def occupancy_ranking(fct_occupancy: DataFrame, years: Years = None, n: int = 15) -> DataFrame:
    """Q12, SL2. The first n departments of the summary."""
    return topk.top(_occupancy_by_department(fct_occupancy, years), n, "avg_occupancy", "department")


def gdp_by_year(fct_gdp: DataFrame, years: Years = None) -> DataFrame:
    """Q13."""
    return in_years(fct_gdp, years).orderBy("year")


def gdp_latest(fct_gdp: DataFrame, years: Years = None) -> DataFrame:
    """Q13, WF4. The row of the last year."""
    return windows.last_by(in_years(fct_gdp, years), "year")


def _gdp_and_occupancy(fct_gdp: DataFrame, fct_occupancy: DataFrame, years: Years) -> DataFrame:
    yearly = in_years(fct_occupancy, years).groupBy("year").agg(
        F.round(F.avg("occupancy_rate"), 1).alias("avg_occupancy")
    )
    points = joins.matching_years(in_years(fct_gdp, years), yearly)
    return points.select("year", "tourism_gdp_billions_cop", "avg_occupancy")


def gdp_vs_occupancy(fct_gdp: DataFrame, fct_occupancy: DataFrame, years: Years = None) -> DataFrame:
    """Q14, AG8, J1. Points of the scatter with the value of the fitted line."""
    points = _gdp_and_occupancy(fct_gdp, fct_occupancy, years)
    return statistics.with_fitted(points, "avg_occupancy", "tourism_gdp_billions_cop").orderBy("year")


def gdp_occupancy_line(fct_gdp: DataFrame, fct_occupancy: DataFrame, years: Years = None) -> DataFrame:
    """Q14, ST-R1. The least squares line of GDP on occupancy."""
    points = _gdp_and_occupancy(fct_gdp, fct_occupancy, years)
    return statistics.least_squares_line(points, "avg_occupancy", "tourism_gdp_billions_cop")


def _flows(fct: DataFrame, years: Years, movement: str | None) -> DataFrame:
    choice = movement.lower() if movement and movement != fixed.NO_FILTER else None
    return equal_unless_all(in_years(fct, years), "movement_type", choice)


def flows_by_year(fct_migration: DataFrame, years: Years = None, movement: str | None = None) -> DataFrame:
    """Q15, AG10."""
    totals = agg.total_by(
        _flows(fct_migration, years, movement), ["year", "movement_type"], total_travelers="number_of_travelers"
    )
    return totals.orderBy("year", "movement_type")


def net_migration(fct_migration: DataFrame, years: Years = None) -> DataFrame:
    """Q16, AG11."""
    yearly = agg.sums_by_category(
        in_years(fct_migration, years), ["year"], "movement_type", "number_of_travelers",
        {"entradas": fixed.MOVEMENT_IN, "salidas": fixed.MOVEMENT_OUT},
    )
    return yearly.withColumn("balance", F.col("entradas") - F.col("salidas")).orderBy("year")


def top_nationalities(
    fct_migration: DataFrame, years: Years = None, movement: str | None = None, n: int = 10
) -> DataFrame:
    """Q17, SL1."""
    totals = agg.total_by(
        _flows(fct_migration, years, movement), ["nationality", "movement_type"],
        total_travelers="number_of_travelers",
    )
    return topk.top(totals, n, "total_travelers", "nationality", "movement_type")


def control_points(fct_migration: DataFrame, years: Years = None, movement: str | None = None) -> DataFrame:
    """Q18, AG6."""
    return agg.ranked_totals(
        _flows(fct_migration, years, movement), "control_point", "number_of_travelers", "total_travelers"
    )


def air_kpis(fct_air: DataFrame, years: Years = None) -> DataFrame:
    """Q19, AG3."""
    return agg.totals_with_distincts(
        in_years(fct_air, years),
        {"total": "total_passengers", "domestic": "domestic_passengers", "international": "international_passengers"},
        {"airports": "airport"},
    )


def air_by_year(fct_air: DataFrame, years: Years = None) -> DataFrame:
    """Q20, AG4."""
    return agg.total_by(
        in_years(fct_air, years), ["year"], domestic="domestic_passengers",
        international="international_passengers", total="total_passengers",
    ).orderBy("year")


def airport_ranking(fct_air: DataFrame, years: Years = None) -> DataFrame:
    """Q21, AG13. The share column is the mean of the monthly shares."""
    by_airport = in_years(fct_air, years).groupBy("airport", "airport_city").agg(
        F.sum("total_passengers").alias("total"),
        F.sum("international_passengers").alias("international"),
        F.round(exact_avg("pct_international", 1), 1).alias("pct_intl"),
    )
    return by_airport.orderBy(F.col("total").desc(), "airport", "airport_city")


def air_seasonality(fct_air: DataFrame, years: Years = None) -> DataFrame:
    """Q22, AG5, J3."""
    monthly = agg.total_by(in_years(fct_air, years), ["month"], total="total_passengers")
    return monthly.withColumn("month_name", month_short_name("month")).orderBy("month")


def balance_by_quarter(fct_balance: DataFrame, years: Years = None) -> DataFrame:
    """Q23, PF13, PF19."""
    rows = in_years(fct_balance, years)
    return topk.ordered(rows.withColumn("periodo", period_label("year", "quarter")), ["year", "quarter"])


def _balance_yearly(fct_balance: DataFrame, years: Years) -> DataFrame:
    return agg.total_by(
        in_years(fct_balance, years), ["year"], income="tourism_income_usd_millions",
        expenditure="tourism_expenditure_usd_millions", balance="tourism_balance_usd_millions",
    )


def balance_by_year(fct_balance: DataFrame, years: Years = None) -> DataFrame:
    """Q24, AG4."""
    return _balance_yearly(fct_balance, years).orderBy("year")


def balance_latest_year(fct_balance: DataFrame, years: Years = None) -> DataFrame:
    """Q24, WF4. The last year with a word for the sign of its balance."""
    word = F.when(F.col("balance") > 0, F.lit(fixed.SURPLUS)).otherwise(F.lit(fixed.DEFICIT))
    return windows.last_by(_balance_yearly(fct_balance, years), "year").withColumn("outcome", word)


def _indicator(fct: DataFrame, code: str, years: Years) -> DataFrame:
    return in_years(fct, years).where(F.col("indicator_code") == F.lit(code))


def regional_arrivals(fct_regional: DataFrame, years: Years = None) -> DataFrame:
    """Q25."""
    rows = _indicator(fct_regional, fixed.ARRIVALS_CODE, years).select("year", "country_name", "value")
    return topk.ordered(rows, ["year", "country_name"])


def regional_receipts(fct_regional: DataFrame, years: Years = None) -> DataFrame:
    """Q26, PF20. In millions."""
    rows = _indicator(fct_regional, fixed.RECEIPTS_CODE, years).select(
        "year", "country_name", scaled("value", 1e6).alias("value_millions")
    )
    return topk.ordered(rows, ["year", "country_name"])


def regional_export_share(fct_regional: DataFrame, years: Years = None) -> DataFrame:
    """Q27."""
    rows = _indicator(fct_regional, fixed.EXPORT_SHARE_CODE, years).select(
        "year", "country_name", F.col("value").alias("pct_exports")
    )
    return topk.ordered(rows, ["year", "country_name"])


def regional_summary(fct_regional: DataFrame, years: Years = None) -> DataFrame:
    """Q28, WF2, AG12. Per country the latest available value of each indicator, as columns.

    The newest value per country and indicator is a windowed top-1 (see `windows.latest_row`).
    """
    latest = windows.latest_row(
        in_years(fct_regional, years).select("country_name", "indicator_code", "year", "value"),
        ["country_name", "indicator_code"], "year", "value",
    )
    value = F.col("value")
    wide = agg.pivot_max(
        latest, ["country_name"], "indicator_code",
        {
            "arrivals": (fixed.ARRIVALS_CODE, value),
            "receipts_usd_m": (fixed.RECEIPTS_CODE, scaled(value, 1e6)),
            "pct_exports": (fixed.EXPORT_SHARE_CODE, F.round(value, 1)),
        },
    )
    return wide.orderBy(F.col("arrivals").desc_nulls_last(), "country_name")


# Q29. Sort keys of the downloads; a unique key at the end makes the order total and lets the range
# partitioning split a period that holds very many rows.
EXPORT_ORDER = {
    "fct_tourism_arrivals": ["year", "month", "arrival_id"],
    "fct_hotel_occupancy": ["year", "month", "occupancy_id"],
    "fct_tourism_gdp": ["year", "gdp_id"],
    "fct_migration_flows": ["year", "month", "migration_id"],
    "fct_air_passengers": ["year", "month", "passenger_id"],
    "fct_tourism_balance": ["year", "quarter", "balance_id"],
    "fct_world_bank_comparison": ["country_name", "indicator_code", "year", "comparison_id"],
    "dim_departments": ["department", "dane_code"],
}


def export_rows(table: str, df: DataFrame, years: Years = None, department: str | None = None) -> DataFrame:
    """Q29, SL3. The filtered, totally ordered rows of a download."""
    if table == "fct_tourism_arrivals":
        df = _arrivals(df, years, department)
    elif table != "dim_departments":
        df = in_years(df, years)
    return topk.ordered(df, EXPORT_ORDER[table])
