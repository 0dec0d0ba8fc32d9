"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estratos.session import scratch_path

#: Whether Spark removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared scratch folder and read it back, which cuts its lineage.

    The shuffle files of the write go as it ends; else they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, label), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _hashable(field: T.StructField) -> Column:
    """Maps cannot be hashed or compared, so values that hold one go in as JSON; other values as they are."""
    column = F.col(f"`{field.name}`")
    if "map<" in field.dataType.simpleString():
        return F.to_json(F.struct(column.alias("v")))
    return F.to_json(F.struct(column.cast("string").alias("v"))) if "variant" in field.dataType.simpleString() else column


def row_hash(df: DataFrame, seed: int) -> Column:
    """A 64-bit hash of all columns of a row; equal rows have equal hashes, nulls count as values of their own."""
    nulls = [F.col(f"`{field.name}`").isNull() for field in df.schema.fields]
    return F.xxhash64(F.lit(seed), *nulls, *[_hashable(field) for field in df.schema.fields])


def unit(key: Column) -> Column:
    """A 64-bit hash as a number from 0 up to 1."""
    return F.shiftrightunsigned(key, 11).cast("double") * F.lit(2.0**-53)


def held_out(id_column: str, folds: int, fold: int) -> Column:
    """crc32(id as text) mod folds = fold; a null id counts as the empty text."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % F.lit(folds)) == F.lit(fold)
