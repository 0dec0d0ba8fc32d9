"""Writers. These are the places where jobs run."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def observed(
    df: DataFrame, year: str | None = None, more: Sequence[Column] = ()
) -> tuple[DataFrame, Observation]:
    """IO21. The frame with row count, first and last year, and `more` aggregates measured while it is written.

    The metrics come with the write itself, so no second pass over the data is made.
    """
    observation = Observation(f"load-{uuid.uuid4().hex}")
    metrics = [F.count(F.lit(1)).alias("num_rows")]
    if year is not None:
        metrics += [F.min(year).alias("year_min"), F.max(year).alias("year_max")]
    return df.observe(observation, *metrics, *more), observation


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), table: str | None = None, more: Sequence[Column] = ()
) -> dict[str, object]:
    """IO6, IO14. Write Parquet, replacing what is there, and return the metrics of the write, `more` among them.

    With `table` the files are also made known to the catalogue under that name, as an external table. With
    partition columns the rows are first rebalanced on them: small partitions are merged, and a value
    that holds very many rows is split over several tasks and files.
    """
    year = "year" if "year" in df.columns else None
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df, observation = observed(df, year, more)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table is None:
        writer.parquet(path)
    else:
        writer.format("parquet").option("path", path).saveAsTable(table)
    return dict(observation.get)


def save_as_table(df: DataFrame, name: str, path: str | None = None) -> int:
    """IO8. Create or replace a catalogue table and return its number of rows; `path` makes it external."""
    if path is not None:
        return int(write_parquet(df, path, table=name)["num_rows"])
    df, observation = observed(df)
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return int(observation.get["num_rows"])


def export_table(spark: SparkSession, name: str, path: str) -> None:
    """IO9. Copy a catalogue table to Parquet files."""
    spark.table(name).write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """IO10. UTF-8 CSV with header, in the frame's order: part files follow each other."""
    writer = df.write.mode("overwrite").options(header=True, encoding="UTF-8", quote='"', escape='"')
    writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], more: Sequence[Column] = ()) -> dict[str, object]:
    """IO20. Parquet in key order within and across files, without one task holding a frequent key.

    Returns the metrics of the write. Equal keys are spread by a hash of the whole row, which takes no part in the declared order.
    """
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    ranged = df.withColumn("_spread", spread).repartitionByRange(*[F.col(k) for k in keys], F.col("_spread"))
    # Observed after the exchange: finding its ranges reads the input a first time.
    ranged = ranged.sortWithinPartitions(*keys).drop("_spread")
    out, observation = observed(ranged, "year" if "year" in df.columns else None, more)
    out.write.mode("overwrite").parquet(path)
    return dict(observation.get)


def archive_payloads(
    spark: SparkSession, paths: str | Sequence[str], archive: str, source: str, on: date
) -> None:
    """IO4. Keep an untouched dated copy of payload files: their bytes, path and length.

    For answers and files up to the size one row may have (2 GB); larger text goes to `archive_lines`.
    """
    files = spark.read.format("binaryFile").load([paths] if isinstance(paths, str) else list(paths))
    files.select("path", "modificationTime", "length", "content").write.mode("overwrite").parquet(
        f"{archive}/{source}/ingest_date={on.isoformat()}"
    )


def archive_lines(spark: SparkSession, paths: str | Sequence[str], archive: str, source: str, on: date) -> None:
    """IO4. Dated copy of text files of any size, line by line, with the file each line came from.

    Lines are split at '\\n' only and their bytes are not decoded, so they stay as they were.
    """
    lines = spark.read.option("lineSep", "\n").text([paths] if isinstance(paths, str) else list(paths))
    lines.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value"
    ).write.mode("overwrite").parquet(f"{archive}/{source}/ingest_date={on.isoformat()}")


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """IO14. Make a lazy frame available to SQL under a name, as a view."""
    df.createOrReplaceTempView(name)
    return df
