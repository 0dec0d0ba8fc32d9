"""Raw loads (B1-B10): read what has landed, conform it, choose the source, write Parquet, report.

The reading and conforming part of each load is a lazy function (`arrivals_files`, `air_csv`, ...); `load`
is the common part that writes. A load takes the landed path, or None where the source is not configured,
and a fallback frame to use instead.
"""

from __future__ import annotations

import hashlib
import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estratos import fixed_values as fixed
from estratos.operators import aggregates, conform, windows
from estratos.operators import sketches as summaries
from estratos.operators.filters import valid_rows
from estratos.schemas import BRONZE
from estratos.sources import readers, sinks

log = logging.getLogger(__name__)

ARRIVALS_PATTERNS = ("*arrivals*.csv", "*llegadas*.csv")
OCCUPANCY_PATTERNS = ("*ocupacion*.csv", "*occupancy*.csv")


def _canonical(df: DataFrame, table: str) -> DataFrame:
    """The canonical columns first, in their types, then whatever else the file had."""
    schema = BRONZE[table]
    extra = [name for name in df.columns if name not in schema.names]
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in df.columns]
    return df.select(*typed, *[F.col("`" + name.replace("`", "``") + "`") for name in extra])


HEADERS = {
    "arrivals": fixed.ARRIVALS_HEADERS,
    "occupancy": fixed.OCCUPANCY_HEADERS,
    "gdp": fixed.GDP_HEADERS,
    "migration": fixed.MIGRATION_HEADERS,
    "air": fixed.AIR_HEADERS,
    "balance": fixed.BALANCE_HEADERS,
}

# What an absent column of a dataset kept as landed is filled with.
ABSENT = {
    "arrivals": {
        "country_of_origin": fixed.UNKNOWN,
        "destination_department": fixed.UNKNOWN,
        "travel_purpose": fixed.DEFAULT_PURPOSE,
        "entry_point": fixed.DEFAULT_ENTRY_POINT,
    },
    "occupancy": {"department": fixed.UNKNOWN},
    "gdp": {"source": fixed.SOURCE_GDP},
    "migration": {"source": fixed.SOURCE_MIGRATION},
}


def as_landed(table: str, raw: DataFrame) -> DataFrame:
    """B1, B2, B7, B8. Canonical headers and types; every row and every gap stays."""
    return _canonical(conform.keep_as_landed(raw, HEADERS[table], BRONZE[table], ABSENT[table]), table)


def _files(spark: SparkSession, folder: str, patterns: Sequence[str], encoding: str) -> DataFrame | None:
    raw = readers.read_csv_by_name(spark, [f"{folder}/{pattern}" for pattern in patterns], encoding, flag_broken=True)
    return None if raw is None else raw.where(~F.col(readers.BROKEN)).drop(readers.BROKEN)


def arrivals_files(spark: SparkSession, folder: str, encoding: str = "UTF-8") -> DataFrame | None:
    """B1. Arrivals files of a drop folder, whatever their headers' order."""
    raw = _files(spark, folder, ARRIVALS_PATTERNS, encoding)
    return None if raw is None else as_landed("arrivals", raw)


def occupancy_files(spark: SparkSession, folder: str, encoding: str = "UTF-8") -> DataFrame | None:
    """B2."""
    raw = _files(spark, folder, OCCUPANCY_PATTERNS, encoding)
    return None if raw is None else as_landed("occupancy", raw)


def indicator_files(
    spark: SparkSession, paths: str | Sequence[str], min_year: int = fixed.BRONZE_MIN_YEAR
) -> DataFrame:
    """B3, B6. Landed indicator answers of one country or several."""
    return valid_rows(readers.read_indicator_files(spark, paths), F.col("year") >= min_year)


def arrivals_csv(
    raw: DataFrame, min_year: int = fixed.BRONZE_MIN_YEAR, read: Observation | None = None
) -> DataFrame:
    """B4."""
    return _canonical(conform.conform_arrivals(raw, min_year, read), "arrivals")


def occupancy_csv(
    raw: DataFrame, min_year: int = fixed.BRONZE_MIN_YEAR, read: Observation | None = None
) -> DataFrame:
    """B5."""
    return _canonical(conform.conform_occupancy(raw, min_year, read), "occupancy")


def gdp_csv(raw: DataFrame) -> DataFrame:
    """B7."""
    return as_landed("gdp", raw)


def migration_csv(raw: DataFrame) -> DataFrame:
    """B8."""
    return as_landed("migration", raw)


def air_csv(raw: DataFrame, min_year: int = fixed.BRONZE_MIN_YEAR, read: Observation | None = None) -> DataFrame:
    """B9."""
    return _canonical(conform.conform_air(raw, min_year, read), "air")


def balance_csv(
    raw: DataFrame, min_year: int = fixed.BRONZE_BALANCE_MIN_YEAR, read: Observation | None = None
) -> DataFrame:
    """B10."""
    return _canonical(conform.conform_balance(raw, min_year, read), "balance")


@dataclass
class LoadReport:
    """IO21. Outcome of one load.

    `rows_broken` are lines that are only part of a row (a quoted cell that is never closed, or, read with
    `multiline=False`, the lines of one with a break), `dates_unreadable` date texts in no known format, `date_order` ("day first", "month first") the order in which the
    date column was read, None without one; all are told by the pass that writes. `distinct` holds
    numbers of distinct keys, `latest` the last row by year, `preview` the first rows as they were written.
    """

    table: str
    path: str
    source_used: str
    num_rows: int
    columns: list[str]
    year_min: int | None
    year_max: int | None
    headers: conform.HeaderReport = field(default_factory=conform.HeaderReport)
    rows_dropped: int = 0
    rows_broken: int = 0
    dates_unreadable: int = 0
    date_order: str | None = None
    distinct: dict[str, int] = field(default_factory=dict)
    latest: dict[str, object] | None = None
    preview: list[dict[str, object]] = field(default_factory=list)


LANDED = "landed"


# The datasets whose loader drops rows outside the valid periods, with the first year each keeps.
MIN_YEARS = {
    "arrivals": fixed.BRONZE_MIN_YEAR,
    "occupancy": fixed.BRONZE_MIN_YEAR,
    "air": fixed.BRONZE_MIN_YEAR,
    "balance": fixed.BRONZE_BALANCE_MIN_YEAR,
    "indicators": fixed.BRONZE_MIN_YEAR,
    "regional": fixed.BRONZE_MIN_YEAR,
}
FILTERED = {"arrivals": arrivals_csv, "occupancy": occupancy_csv, "air": air_csv, "balance": balance_csv}


# The keys of which a load reports the number of distinct values.
KEYS = {
    "arrivals": ("country_of_origin", "destination_department"), "occupancy": ("department",),
    "migration": ("nationality", "control_point"), "air": ("airport",), "gdp": (), "balance": (),
    "indicators": ("indicator_code",), "regional": ("country_code", "indicator_code"),
}
PREVIEW_ROWS = 5


def _measured(table: str, rows: DataFrame, sketches: str | None) -> list[Column]:
    """Aggregates told by the pass that writes: the last row by year and, if they are kept, the sketches of the keys."""
    order = ["year", *[name for name in ("month", "quarter", "value") if name in rows.columns]]
    order += [name for name in BRONZE[table].names if name not in order]
    latest = F.max(F.struct(*[name for name in order if name in rows.columns])).alias("latest")
    keys = [name for name in KEYS[table] if name in rows.columns] if sketches else []
    return [latest, *map(summaries.sketch, keys)]


def _summary_schema(table: str) -> T.StructType:
    columns = T.StructType().add("path", T.StringType()).add("num_rows", T.LongType())
    columns = columns.add("year_min", T.IntegerType()).add("year_max", T.IntegerType())
    for key in KEYS[table]:
        columns = columns.add(f"{key}_sketch", T.BinaryType())
    return columns


def _keep_summary(spark: SparkSession, table: str, path: str, folder: str, metrics: Mapping[str, object]) -> None:
    """Write the summary of a load; a load to a path replaces the summary of the one before."""
    schema = _summary_schema(table)
    row = {name: metrics.get(name) for name in schema.names} | {"path": path}
    of_path = hashlib.md5(path.encode()).hexdigest()
    one = spark.createDataFrame([tuple(row[name] for name in schema.names)], schema)
    one.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{table}/{of_path}")


def summary_of_loads(spark: SparkSession, table: str, folder: str) -> DataFrame:
    """IO21, AG15. Rows, first and last year and estimated distinct keys of all loads of a table, one row.

    Unites the summaries that `load` and `load_indicators` keep in `folder`; no loaded row is read. A key that several
    loads hold counts once.
    """
    kept = spark.read.schema(_summary_schema(table)).parquet(f"{folder}/{table}/*")
    return summaries.united(kept, KEYS[table])


def _report(
    spark: SparkSession, table: str, path: str, source: str, rows: DataFrame, metrics: Mapping[str, object],
    sketches: str | None, **more
) -> LoadReport:
    """The report of a load. Without `sketches` distinct keys are counted exactly, in a pass over the key columns."""
    written = readers.read_table(spark, path, BRONZE[table])
    keys = {f"{name}_count": name for name in KEYS[table]}
    counted = {}
    if sketches:
        _keep_summary(spark, table, path, sketches, metrics)
    if keys and sketches:
        own = hashlib.md5(path.encode()).hexdigest()
        kept = spark.read.schema(_summary_schema(table)).parquet(f"{sketches}/{table}/{own}")
        counted = summaries.united(kept, KEYS[table]).first().asDict()
    elif keys:
        counted = aggregates.load_metrics(written, distinct=keys).first().asDict()
    last = metrics["latest"] and metrics["latest"].asDict()
    return LoadReport(
        table=table,
        path=path,
        source_used=source,
        num_rows=int(metrics["num_rows"]),
        columns=rows.columns,
        year_min=metrics["year_min"],
        year_max=metrics["year_max"],
        distinct={name: counted[name] for name in keys},
        latest=last and {name: last.get(name) for name in BRONZE[table].names},
        preview=[row.asDict() for row in written.take(PREVIEW_ROWS)],
        **more,
    )


def load(
    spark: SparkSession,
    table: str,
    landed: str | Sequence[str] | None,
    fallback: DataFrame,
    path: str,
    archive: str | None = None,
    on: date | None = None,
    encoding: str = "UTF-8",
    min_year: int | None = None,
    multiline: bool = True,
    sketches: str | None = None,
) -> LoadReport:
    """IO1, IO3, IO4, IO16, IO6, IO21. Load one landed CSV dataset into bronze.

    `landed` is a path of files with one header, or a list of name patterns for files with several. Arrivals
    and occupancy found by pattern are kept as landed (B1, B2), those at a path are conformed (B4, B5). The
    landed files are archived before they are parsed; a failure to archive is raised. The fallback is used when
    nothing has landed, the files cannot be read, or no valid row is left. Cells may hold line breaks.
    `multiline=False` says that none does, which saves a pass; the lines of one that does are left out and counted.
    With the folder `sketches` the write also makes sketches of the keys: the report tells their estimates instead of
    counting, and `summary_of_loads` unites them over many loads.
    """
    headers = conform.HeaderReport()
    raw: DataFrame | None = None
    filtered = table in FILTERED and not (table in ABSENT and landed is not None and not isinstance(landed, str))

    def conformed(broken: Observation | None = None, read: Observation | None = None) -> DataFrame:
        whole = raw
        if broken is not None:
            whole = whole.observe(broken, F.count_if(readers.BROKEN).alias("rows_broken"))
        whole = whole.where(~F.col(readers.BROKEN)).drop(readers.BROKEN)
        if not filtered:
            return as_landed(table, whole)
        return FILTERED[table](whole, MIN_YEARS[table] if min_year is None else min_year, read)

    def primary() -> DataFrame | None:
        nonlocal headers, raw
        read = readers.read_csv if isinstance(landed, str) else readers.read_csv_by_name
        raw = read(spark, landed, encoding, multiline, flag_broken=True)
        if raw is None:
            return None
        columns = [name for name in raw.columns if name != readers.BROKEN]
        headers = conform.header_report(columns, HEADERS[table], BRONZE[table].names)
        return conformed()

    if landed and archive is not None:
        files = readers.list_files(spark, [landed] if isinstance(landed, str) else landed)
        if files:
            sinks.archive_lines(spark, landed if isinstance(landed, str) else files, archive, table, on or date.today())
    rows, source = readers.choose_source(primary if landed else None, lambda: fallback, LANDED)
    broken = read = None
    if source == LANDED:
        # What is read, broken or unreadable is counted in the same pass that writes the rows kept.
        broken = Observation(f"broken-{uuid.uuid4().hex}")
        read = Observation(f"read-{uuid.uuid4().hex}") if filtered else None
        rows = conformed(broken, read)
    try:
        metrics = sinks.write_parquet(rows, path, more=_measured(table, rows, sketches))
    except (PySparkException, Py4JJavaError) as error:
        if source != LANDED or not readers.is_source_error(error):
            raise
        log.warning("the landed files of %s failed while they were loaded, using the fallback: %s", table, error)
        rows, source, broken, read = fallback, "fallback", None, None
        metrics = sinks.write_parquet(rows, path, more=_measured(table, rows, sketches))
    counts = {"rows_broken": int(broken.get["rows_broken"])} if broken is not None else {}
    if read is not None:
        counts["rows_dropped"] = int(read.get["rows_read"]) - int(metrics["num_rows"])
        counts["dates_unreadable"] = int(read.get["dates_unreadable"])
        counts["date_order"] = {True: "day first", False: "month first"}.get(read.get["day_first"])
    return _report(spark, table, path, source, rows, metrics, sketches, headers=headers, **counts)


INDICATOR_TABLES = ("indicators", "regional")


def load_indicators(
    spark: SparkSession,
    table: str,
    landed: str | None,
    fallback: DataFrame,
    path: str,
    archive: str | None = None,
    on: date | None = None,
    min_year: int | None = None,
    sketches: str | None = None,
) -> LoadReport:
    """B3, B6, IO20. As `load`, for landed indicator answers; the table is written in order of country, code and year."""

    def primary() -> DataFrame:
        return indicator_files(spark, landed, MIN_YEARS[table] if min_year is None else min_year)

    if landed and archive is not None and readers.list_files(spark, [landed]):
        sinks.archive_payloads(spark, landed, archive, table, on or date.today())
    rows, source = readers.choose_source(primary if landed else None, lambda: fallback, LANDED)
    rows = rows.select(*BRONZE[table].names)
    more = _measured(table, rows, sketches)
    metrics = sinks.write_sorted(rows, path, ["country_code", "indicator_code", "year"], more)
    return _report(spark, table, path, source, rows, metrics, sketches)


def latest_indicator(rows: DataFrame, code: str = fixed.ARRIVALS_CODE) -> DataFrame:
    """IO21, WF4. Last year and value of one indicator, for the report of a load."""
    return windows.last_by(rows.where(F.col("indicator_code") == F.lit(code)), "year", "value").select("year", "value")
