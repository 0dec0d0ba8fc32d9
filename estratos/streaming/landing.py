"""New-file loads (ST1): every file that lands in a folder is read once, and conformed as a batch load would.

The file source keeps the names it has seen in the checkpoint. The new files of a run are one static frame, so that
decisions about whole columns ("the date is never filled") are made over all of them, and cells with line breaks are
read as in a batch load.

A run writes to a folder of its own attempt under the sink and is published by a manifest entry, which is written last
and put in place by a rename. Readers take the folders that the manifest names, so they see a run whole or not at all:
what a broken-off attempt left is no part of the table, and a run that is repeated after it was published adds nothing.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from estratos.sources import records
from estratos.sources.readers import BROKEN, csv_options, header_columns, null_tokens_to_null, record_rows

log = logging.getLogger(__name__)

RUN, ATTEMPT, MANIFEST = "run", "attempt", "_manifest"


class Landed(NamedTuple):
    """A stream of landed files and how a batch of it, written to a folder, becomes rows."""

    stream: DataFrame
    stage: Callable[[DataFrame], DataFrame]
    rows: Callable[[DataFrame, str], DataFrame]


class Run(NamedTuple):
    """A published run: its number, the folder of its files under the sink, and how many files, rows read and rows kept."""

    run: int
    folder: str
    files: int
    rows_read: int
    rows_kept: int


def landed_rows(
    spark: SparkSession, folder: str, columns: Sequence[str], encoding: str = "UTF-8", glob: str = "*.csv",
) -> Landed:
    """ST1, IO3. The rows of CSV files in a folder, every column text, cells with line breaks whole.

    All files of the folder have the header `columns`; a file with another header fails the run instead of
    having its values put under wrong names. The first line of a quoted cell that its file never closes is left out.
    """
    names = list(columns)
    if not records.has_lines(encoding):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        reader = spark.readStream.schema(schema).options(**csv_options(encoding, True)).option("pathGlobFilter", glob)
        return Landed(null_tokens_to_null(reader.csv(folder)), lambda batch: batch, lambda staged, _: staged)
    text = spark.readStream.option("lineSep", "\n").option("pathGlobFilter", glob).text(folder)
    scan = text.select("value", "_metadata.file_path", "_metadata.file_block_start")

    def stage(batch: DataFrame) -> DataFrame:
        named = batch.select("value", F.struct("file_path", "file_block_start").alias("_metadata"))
        return records.pieces(records.with_lines(named).withColumn("value", records.text_of(encoding)))

    def rows(staged: DataFrame, scratch: str) -> DataFrame:
        found = records.csv_records(staged, scratch)
        for row in found.where("header").select("record").distinct().toLocalIterator():
            if [name.lower() for name in header_columns(row["record"])] != [name.lower() for name in names]:
                raise ValueError(f"a landed file has the header {row['record']!r} and not {names}")
        return record_rows(found, names, True)

    return Landed(scan, stage, rows)


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its way to name paths: Spark has no call of its own that renames a file."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def publish(spark: SparkSession, sink: str, run: Run) -> None:
    """ST1. Add a run to the manifest of a sink: its entry is written under another name and then renamed."""
    files, at = _file_system(spark, sink)
    unfinished, entry = at(f"{sink}/{MANIFEST}/_{uuid.uuid4().hex}"), at(f"{sink}/{MANIFEST}/{RUN}-{run.run:012d}.json")
    out = files.create(unfinished)
    out.write(bytearray(json.dumps(run._asdict()).encode()))
    out.close()
    if not files.rename(unfinished, entry) and not files.exists(entry):
        raise OSError(f"cannot put the manifest entry {entry} in place")


def published(spark: SparkSession, sink: str) -> list[Run]:
    """ST1. The published runs of a sink in order, one for each time that files had landed."""
    files, at = _file_system(spark, sink)
    pattern = f"{sink}/{MANIFEST}/{RUN}-*.json"
    if not files.globStatus(at(pattern)):
        return []
    entries = spark.read.schema("run long, folder string, files long, rows_read long, rows_kept long").json(pattern)
    return [Run(*row) for row in entries.orderBy("run").toLocalIterator()]


def ingest(
    landed: Landed, transform: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str,
    partition_by: Sequence[str] = (), every: str | None = None, count: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """ST1. Write the transformed rows of each run to Parquet under `sink` and publish them.

    Without `every` all files present are one run and the query ends; with it (such as '60 seconds') the query goes
    on, and what is new at each interval is a run. `count` is told the input rows of each run.
    """

    def write(batch: DataFrame, run: int) -> None:
        session = batch.sparkSession
        known = [r for r in published(session, sink) if r.run == run]
        if not known:
            # Written before it is conformed, so that the files are read once however often the columns are looked at.
            staged = f"{checkpoint}/staged"
            kept = landed.stage(batch)
            kept.write.mode("overwrite").parquet(staged)
            rows = landed.rows(session.read.schema(kept.schema).parquet(staged), f"{checkpoint}/staged-blocks")
            if BROKEN in rows.columns:
                rows = rows.where(~F.col(BROKEN)).drop(BROKEN)
            read = rows.count()
            folder = f"{RUN}={run}/{ATTEMPT}={uuid.uuid4().hex}"
            out = transform(rows).write
            if partition_by:
                out = out.partitionBy(*partition_by)
            out.parquet(f"{sink}/{folder}")
            files = session.read.option("recursiveFileLookup", "true").format("binaryFile").load(f"{sink}/{folder}")
            files = files.select("path").count()
            known = [Run(run, folder, files, read, session.read.parquet(f"{sink}/{folder}").count() if files else 0)]
            publish(session, sink, known[0])
        if count is not None:
            count(known[0].rows_read)

    writer = landed.stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/log")
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def loaded_rows(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """ST1. What all published runs have written."""
    folders = [f"{sink}/{run.folder}" for run in published(spark, sink)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", sink).parquet(*folders).select(*schema.names)


def load_new_files(
    spark: SparkSession, folder: str, columns: Sequence[str], transform: Callable[[DataFrame], DataFrame],
    sink: str, checkpoint: str, partition_by: Sequence[str] = (), encoding: str = "UTF-8",
) -> int:
    """ST1. Load what has landed since the last run and return the number of input rows.

    A folder that cannot be listed is logged and counts as nothing new.
    """
    counted: list[int] = []
    try:
        rows = landed_rows(spark, folder, columns, encoding)
        ingest(rows, transform, sink, checkpoint, partition_by, count=counted.append).awaitTermination()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("cannot list %s: %s", folder, error)
    return sum(counted)
