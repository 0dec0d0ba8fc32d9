"""Readers. Nothing infers a schema: text files are read as text, typed files with a stated schema."""

from __future__ import annotations

import csv
import io
import logging
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estratos.fixed_values import NULL_TOKENS
from estratos.operators.conform import with_country_name, with_indicator_name
from estratos.operators.quality import MissingColumns, require_columns
from estratos.operators.sets import concat_by_name
from estratos.schemas import DEPARTMENT_SEED, INDICATOR_RECORDS
from estratos.session import scratch_path
from estratos.sources import records

log = logging.getLogger(__name__)


def csv_options(encoding: str = "UTF-8", multiline: bool = False) -> dict[str, str]:
    """Options shared by batch and streaming: header, quotes doubled inside quotes, bad bytes replaced.

    `multiline` is Spark's own way to read line breaks in quoted cells, in which a file is one task.
    """
    return {
        "header": "true",
        "encoding": encoding,
        "quote": '"',
        "escape": '"',
        "multiLine": str(multiline).lower(),
        "mode": "PERMISSIVE",
        "enforceSchema": "false",
    }


def null_tokens_to_null(df: DataFrame, but: Sequence[str] = ()) -> DataFrame:
    """Cells holding one of the usual words for 'missing' become null, in all columns but the named ones."""

    def cleaned(name: str) -> Column:
        c = F.col("`" + name.replace("`", "``") + "`")
        return F.when(~c.isin(NULL_TOKENS), c).alias(name)

    return df.select(*[F.col(name) if name in but else cleaned(name) for name in df.columns])


#: Column of `read_csv` and `read_csv_by_name` that is true for a line that is only part of a row.
BROKEN = "_broken_row"


def _rows(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], options: dict[str, str], flag: bool) -> DataFrame:
    """All columns as text. A line is part of a row if it lacks cells and holds a quote that is not closed."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if not flag:
        return null_tokens_to_null(spark.read.schema(schema).options(**options).csv(paths))
    raw = spark.read.schema(schema.add("_line", T.StringType())).options(**options)
    raw = raw.option("columnNameOfCorruptRecord", "_line").csv(paths)
    quotes = F.length("_line") - F.length(F.translate("_line", '"', ""))
    broken = F.coalesce(quotes % 2 == 1, F.lit(False))
    # Spark only sees that cells are lacking when it has to read them all, so the flag depends on every column.
    cells = F.length(F.concat_ws("", *["`" + c.replace("`", "``") + "`" for c in columns]))
    flagged = raw.withColumn(BROKEN, broken & (cells >= 0))
    return null_tokens_to_null(flagged.drop("_line"), [BROKEN])


def record_rows(found: DataFrame, columns: Sequence[str], flag: bool) -> DataFrame:
    """IO3. The rows of `records.csv_records`, every column text; headers are left out.

    With `flag` the column `BROKEN` tells the first line of a cell that its file never closes.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    ddl = ", ".join("`" + f.name.replace("`", "``") + "` string" for f in schema)
    cells = F.from_csv("record", ddl, {"quote": '"', "escape": '"', "multiLine": "true"})
    # Generated, so that a record is parsed once and not for each use of one of its cells.
    parsed = found.where(~F.col("header")).select(F.inline(F.array(cells)), F.col("broken").alias(BROKEN))
    return null_tokens_to_null(parsed if flag else parsed.drop(BROKEN), [BROKEN])


def header_columns(header: str) -> list[str]:
    """The column names of a header record; an empty name is `_c0` by its place, a repeated one gets its place added."""
    names = next(csv.reader(io.StringIO(header, newline="")), [])
    folded = [name.lower() for name in names]
    return [
        f"_c{i}" if not name.strip() else f"{name}{i}" if folded.count(name.lower()) > 1 else name
        for i, name in enumerate(names)
    ]


def found_records(spark: SparkSession, files: Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """IO3. The records of files with line breaks in their cells. They are written to the scratch folder as they are read."""
    staged = scratch_path(spark, "csv-pieces")
    lines = records.with_lines(records.text_scan(spark, files, encoding))
    records.pieces(lines.withColumn("value", records.text_of(encoding))).write.parquet(staged)
    return records.csv_records(spark.read.schema(records.PIECES).parquet(staged), scratch_path(spark, "csv-blocks"))


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8", multiline: bool = True,
    flag_broken: bool = False,
) -> DataFrame:
    """IO2, IO3, IO19. CSV files that share one header, every column text.

    Cells may hold line breaks: a first pass looks for lines that leave a cell open. Files without one are read as they
    are, the others by their records, and both kinds are split between tasks. With `multiline=False` the caller says
    that no cell holds a break, which saves that pass; the lines of a row that does are then rows of their own.
    `flag_broken` adds the column `BROKEN`, which tells the lines that are only part of a row.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    whole_files = multiline and not records.has_lines(encoding)
    options = csv_options(encoding, whole_files)
    raw = spark.read.options(**options).csv(paths)
    if multiline and not whole_files:
        files = list_files(spark, paths)
        broken = [path for path, (_, opens) in surveyed(spark, files, encoding, True).items() if opens]
        if broken:
            found = found_records(spark, broken, encoding)
            header = found.where("header").select("record").first()
            columns = header_columns(header["record"])
            frames = [record_rows(found, columns, flag_broken)]
            plain = sorted(set(files) - set(broken))
            if plain:
                frames.append(_rows(spark, plain, columns, options, flag_broken))
            return concat_by_name(frames)
    if not flag_broken:
        return null_tokens_to_null(raw)
    return _rows(spark, paths, raw.columns, options, True)


def list_files(spark: SparkSession, patterns: Sequence[str]) -> list[str]:
    """Files matched by any of the patterns, each once; a pattern without a match adds nothing.

    Only the listing is read: the content column is not selected.
    """
    found: dict[str, None] = {}
    for pattern in patterns:
        try:
            files = spark.read.format("binaryFile").load(pattern).select("path")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found.update(dict.fromkeys(row.path for row in files.toLocalIterator()))
    return list(found)


def surveyed(spark: SparkSession, files: Sequence[str], encoding: str, breaks: bool) -> dict[str, tuple[str, bool]]:
    """For each file its first line that is not blank and, with `breaks`, whether a line of it leaves a cell open.

    One job, however many files there are; without `breaks` only their first blocks count. Empty files are left out.
    """
    lines = records.with_lines(records.text_scan(spark, files, encoding))
    if not breaks:
        lines = lines.where("block = 0")
    head = (F.col("block") == 0) & (F.trim("value") != "")
    opens = records.opens_cell(F.col("value")) if breaks else F.lit(False)
    # A row for each block before they are grouped: the least of many texts would be found by sorting the lines.
    told = lines.select("path", "block", F.when(head, F.col("raw")).alias("raw"), opens.alias("opens"))
    heads = records.block_heads(told.where("opens or raw is not null"))
    found = heads.groupBy("path").agg(F.max("raw").alias("raw"), F.bool_or("opens").alias("opens")).where("raw is not null")
    found = found.select("path", "opens", "raw", F.rtrim(F.make_valid_utf8(F.col("raw").cast("string")), F.lit("\r")).alias("value"))
    found = found.select("path", "opens", records.text_of(encoding).alias("header"))
    return {unquote(row["path"]): (row["header"], row["opens"]) for row in found.orderBy("path").toLocalIterator()}


def files_by_header(spark: SparkSession, files: Sequence[str], encoding: str = "UTF-8") -> dict[str, list[str]]:
    """IO1. The files of each header line, found in one job however many files there are; empty files are left out."""
    groups: dict[str, list[str]] = {}
    for path, (header, _) in surveyed(spark, files, encoding, False).items():
        groups.setdefault(header, []).append(path)
    return groups


def read_csv_by_name(
    spark: SparkSession, patterns: Sequence[str], encoding: str = "UTF-8", multiline: bool = True,
    flag_broken: bool = False,
) -> DataFrame | None:
    """IO1, IO3. All CSV files matching any pattern, concatenated by column name; None if there is no file.

    Spark reads the columns of several files by position, so files are read in groups of equal header. One job finds
    the header lines, and, as in `read_csv`, the files with line breaks in their cells; each different header is then
    looked at once.
    """
    files = list_files(spark, patterns)
    if not files:
        return None
    whole_files = multiline and not records.has_lines(encoding)
    options = csv_options(encoding, whole_files)
    if whole_files:
        return concat_by_name([null_tokens_to_null(spark.read.options(**options).csv(path)) for path in files])
    frames, groups, broken = [], {}, []
    for path, (header, opens) in surveyed(spark, files, encoding, multiline).items():
        if opens:
            broken.append(path)
        else:
            groups.setdefault(header, []).append(path)
    for paths in groups.values():
        columns = spark.read.options(**options).csv(paths[0]).columns
        if columns:
            frames.append(_rows(spark, paths, columns, options, flag_broken))
    if broken:
        found = found_records(spark, broken, encoding)
        heads = found.where("header").select("path", "record")
        of_header: dict[str, list[str]] = {}
        for row in heads.orderBy("path").toLocalIterator():
            of_header.setdefault(row["record"], []).append(row["path"])
        for header, paths in of_header.items():
            own = found if len(of_header) == 1 else found.where(F.col("path").isin(paths))
            frames.append(record_rows(own, header_columns(header), flag_broken))
    return concat_by_name(frames) if frames else None


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """IO7. Parquet with a stated schema."""
    return require_columns(spark.read.schema(schema).parquet(path), schema.names)


def read_seed(spark: SparkSession, path: str, schema: T.StructType = DEPARTMENT_SEED) -> DataFrame:
    """IO11. A catalogue in CSV, its columns found by header; codes stay text, so '05' keeps its zero."""
    raw = spark.read.options(**csv_options()).csv(path)
    return require_columns(raw, schema.names).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def parse_indicator_payloads(
    df: DataFrame, payload: str = "payload", source: str = "world_bank", code: str | None = None,
    country_code: str | None = None,
) -> DataFrame:
    """IO5, PF22. Rows of the records in service answers `[metadata, [record, ...]]`.

    Answers of another shape and records without a value yield no rows. `code` and `country_code` name columns of
    `df` that say what was asked for; a service answers with ids and names of its own, so the asked codes are kept and
    the names come from the catalogue. Where a code was not asked for (or the column is null) or is not in the
    catalogue, the record's own id or name is used.
    """
    records = F.from_json(F.get_json_object(F.col(payload), "$[1]"), INDICATOR_RECORDS)
    rows = df.withColumn("_record", F.explode(records)).where(F.col("_record.value").isNotNull())

    def asked(column: str | None, own: str) -> Column:
        return F.col(own) if column is None else F.coalesce(F.col(column), F.col(own))

    rows = rows.select(
        F.col("_record.date").try_cast("int").alias("year"),
        asked(code, "_record.indicator.id").alias("indicator_code"),
        F.col("_record.indicator.value").alias("_indicator"),
        F.col("_record.value").alias("value"),
        asked(country_code, "_record.country.id").alias("country_code"),
        F.col("_record.country.value").alias("_country"),
        F.lit(source).alias("source"),
    )
    named = with_country_name(with_indicator_name(rows, alias="_known"), alias="_home")
    return named.select(
        "year", "indicator_code", F.coalesce("_known", "_indicator").alias("indicator_name"), "value",
        "country_code", F.coalesce("_home", "_country").alias("country_name"), "source",
    )


#: Where the path of a landed answer says what was asked for: folders `country_code=COL/indicator_code=ST.INT.ARVL/`,
#: or a name such as `COL_ST.INT.ARVL.json`.
COUNTRY_IN_PATH = ("country_code=([^/]+)/", "(?:^|/)([A-Z]{3})_[A-Z][A-Z0-9.]*[.][a-z]+$")
CODE_IN_PATH = ("indicator_code=([^/]+)/", "(?:^|/)[A-Z]{3}_([A-Z][A-Z0-9.]*)[.][a-z]+$")


def read_indicator_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """IO5. Landed answers, one per file: each is a single page of the service, so a row holds a whole file.

    What was asked for is taken from the path of the file, as `COUNTRY_IN_PATH` and `CODE_IN_PATH` find it.
    """
    text = spark.read.text([paths] if isinstance(paths, str) else list(paths), wholetext=True)

    def found(patterns: Sequence[str]) -> Column:
        return F.coalesce(*[F.nullif(F.regexp_extract("_metadata.file_path", p, 1), F.lit("")) for p in patterns])

    answers = text.select(
        F.col("value").alias("payload"), found(CODE_IN_PATH).alias("_code"), found(COUNTRY_IN_PATH).alias("_from")
    )
    return parse_indicator_payloads(answers, code="_code", country_code="_from")


#: Error conditions that say that a source is not there or cannot be read as what it should be.
SOURCE_ERRORS = (
    "PATH_NOT_FOUND", "FAILED_READ_FILE", "UNABLE_TO_INFER_SCHEMA", "MALFORMED_CSV_RECORD", "MALFORMED_RECORD_IN_PARSING",
    "UNSUPPORTED_DATASOURCE_FOR_DIRECT_QUERY",
)


def is_source_error(error: Exception) -> bool:
    """True if a source is missing or unreadable; false for a lost executor, a fault in a plan, or anything else."""
    if isinstance(error, MissingColumns):
        return True
    if isinstance(error, PySparkException) and (error.getCondition() or "").startswith(SOURCE_ERRORS):
        return True
    cause, seen = getattr(error, "java_exception", None) or getattr(error, "_origin", None), 0
    while cause is not None and seen < 20:
        condition = cause.getCondition() if hasattr(cause, "getCondition") and _has(cause, "getCondition") else None
        if condition and condition.startswith(SOURCE_ERRORS):
            return True
        cause, seen = cause.getCause(), seen + 1
    return False


def _has(java_object, method: str) -> bool:
    return any(m.getName() == method for m in java_object.getClass().getMethods())


def choose_source(
    primary: Callable[[], DataFrame | None] | None,
    fallback: Callable[[], DataFrame],
    primary_name: str = "primary",
    fallback_name: str = "fallback",
) -> tuple[DataFrame, str]:
    """IO16. The primary source, or the fallback when it is not configured, cannot be read, or is empty.

    Reads at most one row to decide. Only errors of the source itself lead to the fallback (`is_source_error`); a lost
    executor or a fault in a plan is raised, so that it never replaces real data.
    """
    if primary is not None:
        try:
            df = primary()
            # A whole row is read, and not just counted: only then does a file that cannot be read show itself.
            if df is not None and df.take(1):
                return df, primary_name
        except (PySparkException, Py4JJavaError, MissingColumns) as error:
            if not is_source_error(error):
                raise
            log.warning("source %s failed, using %s: %s", primary_name, fallback_name, error)
    return fallback(), fallback_name


def read_or_else(
    primary: Callable[[], DataFrame | None] | None,
    fallback: Callable[[], DataFrame],
    primary_name: str = "primary",
    fallback_name: str = "fallback",
    alias: str = "source_used",
) -> DataFrame:
    """IO16. As `choose_source`, with the name of the source that was used as a column."""
    df, name = choose_source(primary, fallback, primary_name, fallback_name)
    return df.withColumn(alias, F.lit(name))
