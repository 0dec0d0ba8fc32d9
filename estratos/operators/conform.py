"""Bringing raw files to a canonical table: headers, missing columns, lenient numbers, derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estratos import fixed_values as fixed
from estratos.functions import clamp, fits_one_order, lenient_double, lenient_int, mid_month, parse_date
from estratos.operators.filters import valid_rows

Headers = Mapping[str, Sequence[str]]


def header_key(name: str) -> str:
    """Headers are compared without outer spaces, in lower case, '-' and ' ' written as '_'.

    A byte order mark before the first header, and the quotes it leaves around it, are dropped.
    """
    if name.startswith("\ufeff"):
        name = name[1:].strip().strip('"')
    return name.strip().lower().replace("-", "_").replace(" ", "_")


@dataclass
class HeaderReport:
    """What happened to the columns of one load."""

    renamed: dict[str, str] = field(default_factory=dict)
    merged: dict[str, list[str]] = field(default_factory=dict)
    unmapped: list[str] = field(default_factory=list)
    defaulted: list[str] = field(default_factory=list)


def match_headers(columns: Sequence[str], headers: Headers) -> tuple[dict[str, list[str]], list[str]]:
    """Source columns per target, in order of preference, and the columns no target claims."""
    by_key: dict[str, list[str]] = {}
    for name in columns:
        by_key.setdefault(header_key(name), []).append(name)
    claimed: dict[str, list[str]] = {}
    for target, aliases in headers.items():
        keys = dict.fromkeys(header_key(alias) for alias in aliases)
        sources = [name for key in keys for name in by_key.get(key, [])]
        if sources:
            claimed[target] = sources
    taken = {name for sources in claimed.values() for name in sources}
    return claimed, [name for name in columns if name not in taken]


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def harmonise_headers(df: DataFrame, headers: Headers, keep_unmapped: bool = True) -> DataFrame:
    """PF1. Rename header variants to canonical names.

    Several sources of one target are merged to their first non-null value; unmapped columns stay unless
    told otherwise.
    """
    claimed, unmapped = match_headers(df.columns, headers)
    merged = [F.coalesce(*[_quoted(s) for s in sources]).alias(target) for target, sources in claimed.items()]
    return df.select(*merged, *([_quoted(name) for name in unmapped] if keep_unmapped else []))


def header_report(columns: Sequence[str], headers: Headers, required: Sequence[str]) -> HeaderReport:
    """PF1, PF2. The report of a load, from the column names alone."""
    claimed, unmapped = match_headers(columns, headers)
    return HeaderReport(
        renamed={sources[0]: target for target, sources in claimed.items() if sources[0] != target},
        merged={target: sources for target, sources in claimed.items() if len(sources) > 1},
        unmapped=unmapped,
        defaulted=[name for name in required if name not in claimed],
    )


def add_missing(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """PF2. Add absent columns as constants; nulls in present columns stay."""
    absent = {name: F.lit(value) for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _ints(df: DataFrame, defaults: Mapping[str, int], kind: str = "int") -> dict[str, Column]:
    """PF3. Lenient integers of the named columns; an absent column is all default."""
    return {
        name: lenient_int(name, default, _is_text(df, name), kind)
        if name in df.columns
        else F.lit(int(default)).cast(kind)
        for name, default in defaults.items()
    }


def _counts(df: DataFrame, *names: str) -> dict[str, Column]:
    return _ints(df, {name: 0 for name in names}, "bigint")


def _doubles(df: DataFrame, defaults: Mapping[str, float]) -> dict[str, Column]:
    return {
        name: lenient_double(name, default, _is_text(df, name)) if name in df.columns else F.lit(float(default))
        for name, default in defaults.items()
    }


def never_set(df: DataFrame, name: str) -> Column:
    """True when the column is null in every row: a scalar subquery that reads this column only.

    A stream has no last row; files that land are conformed as the static frame of their run.
    """
    return df.agg(F.count(name)).scalar() == 0


def sums_to_zero(df: DataFrame, value: Column) -> Column:
    """True when an integer expression sums to zero over all rows, or there are none."""
    return df.agg(F.coalesce(F.sum(value), F.lit(0))).scalar() == 0


def reads_day_first(df: DataFrame, name: str) -> Column:
    """PF4. Whether the dates of a text column have the day first: one order for the whole column.

    Each text that is a date in one order only, such as 15/04/2022, is a vote for that order; with as many votes for
    either, as where every day is below 13, the month comes first. A scalar subquery that reads this column only.
    """
    votes = [F.count_if(fits_one_order(name, day_first)) for day_first in (True, False)]
    return df.agg(votes[0] > votes[1]).scalar()


def _in_period(
    df: DataFrame, min_year: int, part: str, last: int, read: Observation | None, unreadable: Column | None = None,
    day_first: Column | None = None,
) -> DataFrame:
    """PF12. Keep valid periods; `read` counts the rows before the filter, and unreadable dates, while they pass, and
    tells the order of the dates."""
    if read is not None:
        bad = F.count_if(F.lit(False) if unreadable is None else F.coalesce(unreadable, F.lit(False)))
        order = F.bool_or(F.lit(None).cast("boolean") if day_first is None else day_first)
        df = df.observe(read, F.count(F.lit(1)).alias("rows_read"), bad.alias("dates_unreadable"), order.alias("day_first"))
    return valid_rows(df, F.col("year") >= min_year, F.col(part).between(1, last))


def conform_arrivals(
    raw: DataFrame, min_year: int = fixed.BRONZE_MIN_YEAR, read: Observation | None = None
) -> DataFrame:
    """PF1-PF5, PF12. Raw arrivals files to the canonical arrivals table.

    Year and month come from the date where their column is absent; the date is built as day 15 where its
    column is absent or never filled.
    """
    df = harmonise_headers(raw, fixed.ARRIVALS_HEADERS)
    df = add_missing(
        df,
        {
            "country_of_origin": fixed.UNKNOWN,
            "destination_department": fixed.UNKNOWN,
            "travel_purpose": fixed.DEFAULT_PURPOSE,
            "entry_point": fixed.DEFAULT_ENTRY_POINT,
        },
    )
    has_date = "arrival_date" in df.columns
    day_first = reads_day_first(df, "arrival_date") if has_date and _is_text(df, "arrival_date") else F.lit(None).cast("boolean")
    df = df.withColumn("_day_first", day_first)
    # A column of its own, so that a text is parsed once and not for each use of its date.
    parsed = parse_date("arrival_date", day_first=F.col("_day_first")) if has_date else F.lit(None).cast("date")
    df, date = df.withColumn("_date", parsed), F.col("_date")
    unreadable = F.col("arrival_date").isNotNull() & date.isNull() if has_date else F.lit(False)
    # A derived part equals the date's; an unreadable date leaves 0, which the period filter drops.
    parts = _ints(df, {name: 0 for name in ("year", "month") if name in df.columns})
    if "year" not in parts:
        parts["year"] = F.coalesce(F.year(date), F.lit(0))
    if "month" not in parts:
        parts["month"] = F.coalesce(F.month(date), F.lit(0))
    built = mid_month(parts["year"], parts["month"])
    if has_date:
        date = F.when(never_set(df, "arrival_date"), built).otherwise(date)
    else:
        date = built
    df = df.withColumns(
        parts
        | {"arrival_date": date, "_date_unreadable": unreadable}
        | _counts(df, "number_of_visitors")
        | _doubles(df, {"estimated_spending_usd": 0.0})
    )
    kept = _in_period(df, min_year, "month", 12, read, F.col("_date_unreadable"), F.col("_day_first"))
    return kept.drop("_date_unreadable", "_day_first", "_date")


def conform_occupancy(
    raw: DataFrame, min_year: int = fixed.BRONZE_MIN_YEAR, read: Observation | None = None
) -> DataFrame:
    """PF1-PF3, PF6, PF7, PF12. Raw occupancy files to the canonical occupancy table.

    Occupied rooms are derived from the rate where their column is absent or never filled.
    """
    df = harmonise_headers(raw, fixed.OCCUPANCY_HEADERS)
    df = add_missing(df, {"department": fixed.UNKNOWN})
    rate = clamp(_doubles(df, {"occupancy_rate": fixed.DEFAULT_OCCUPANCY_RATE})["occupancy_rate"], 0, 100)
    rooms = _counts(df, "available_rooms")["available_rooms"]
    derived = F.coalesce((rooms * rate / 100).try_cast("bigint"), F.lit(0))
    if "occupied_rooms" in df.columns:
        given = _counts(df, "occupied_rooms")["occupied_rooms"]
        occupied = F.when(never_set(df, "occupied_rooms"), derived).otherwise(given)
    else:
        occupied = derived
    df = df.withColumns(
        {"occupancy_rate": rate, "available_rooms": rooms, "occupied_rooms": occupied}
        | _ints(df, {"year": 0, "month": 0})
        | _doubles(df, {"average_rate_cop": 0.0})
    )
    return _in_period(df, min_year, "month", 12, read)


def conform_air(
    raw: DataFrame, min_year: int = fixed.BRONZE_MIN_YEAR, read: Observation | None = None
) -> DataFrame:
    """PF1-PF3, PF8, PF12. Raw air traffic files; the total is derived where it is absent or sums to zero."""
    df = harmonise_headers(raw, fixed.AIR_HEADERS)
    df = add_missing(df, {"airport": fixed.UNKNOWN, "airport_city": fixed.UNKNOWN})
    numbers = _ints(df, {"year": 0, "month": 0}) | _counts(df, "domestic_passengers", "international_passengers")
    derived = numbers["domestic_passengers"] + numbers["international_passengers"]
    if "total_passengers" in df.columns:
        given = _counts(df, "total_passengers")["total_passengers"]
        total = F.when(sums_to_zero(df, given), derived).otherwise(given)
    else:
        total = derived
    df = df.withColumns(numbers | {"total_passengers": total})
    return _in_period(df, min_year, "month", 12, read)


def conform_balance(
    raw: DataFrame, min_year: int = fixed.BRONZE_BALANCE_MIN_YEAR, read: Observation | None = None
) -> DataFrame:
    """PF1-PF3, PF9, PF12. Raw balance files; the balance is derived only where its column is absent."""
    df = harmonise_headers(raw, fixed.BALANCE_HEADERS)
    numbers = _ints(df, {"year": 0, "quarter": fixed.DEFAULT_QUARTER}) | _doubles(
        df, {"tourism_income_usd_millions": 0.0, "tourism_expenditure_usd_millions": 0.0}
    )
    if "tourism_balance_usd_millions" in df.columns:
        name = "tourism_balance_usd_millions"
        numbers[name] = lenient_double(name, None, _is_text(df, name))
    else:
        numbers["tourism_balance_usd_millions"] = (
            numbers["tourism_income_usd_millions"] - numbers["tourism_expenditure_usd_millions"]
        )
    df = add_missing(df, {"source": fixed.SOURCE_BALANCE}).withColumns(numbers)
    return _in_period(df, min_year, "quarter", 4, read)


def keep_as_landed(
    raw: DataFrame, headers: Headers, schema: T.StructType, defaults: Mapping[str, object]
) -> DataFrame:
    """PF1, PF2 and types only, for datasets whose rows and gaps are left to the cleaned tables.

    A missing or unreadable cell stays null instead of becoming a default, and fractions of whole numbers
    are rounded, halves to even, as the cleaned tables do. Only absent columns get a default.
    """
    df = add_missing(harmonise_headers(raw, headers), defaults)

    def typed(field: T.StructField) -> Column:
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType)
        if isinstance(field.dataType, T.IntegralType):
            number = lenient_double(field.name, None, _is_text(df, field.name))
            return F.rint(number).try_cast(field.dataType)
        if isinstance(field.dataType, T.DoubleType):
            return lenient_double(field.name, None, _is_text(df, field.name))
        if isinstance(field.dataType, T.DateType):
            return parse_date(field.name, day_first=reads_day_first(df, field.name) if _is_text(df, field.name) else None)
        return F.col(field.name)

    return df.withColumns({field.name: typed(field) for field in schema})


def with_indicator_name(df: DataFrame, code: str = "indicator_code", alias: str = "indicator_name") -> DataFrame:
    """PF22. Name of an indicator code from the catalogue, null for an unknown code."""
    pairs = [F.lit(text) for pair in fixed.INDICATORS.items() for text in pair]
    return df.withColumn(alias, F.try_element_at(F.create_map(*pairs), F.col(code)))


def with_country_name(df: DataFrame, code: str = "country_code", alias: str = "country_name") -> DataFrame:
    """PF22. Name of an ISO3 country code of the region, null for others."""
    pairs = [F.lit(text) for pair in fixed.REGIONAL_COUNTRIES.items() for text in pair]
    return df.withColumn(alias, F.try_element_at(F.create_map(*pairs), F.col(code)))
