"""Window operators, arranged so that no task ever holds an unbounded group of input rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estratos.operators.joins import bounded_lookup


def running_totals(
    df: DataFrame,
    partition: str,
    order: str,
    measures: Mapping[str, str],
    partition_domain: tuple[int, int],
    order_domain: tuple[int, int],
) -> DataFrame:
    """WF1. Running sums over `partition` in the order of `order`; rows equal in the order share the value.

    A window over the rows themselves would bring each partition, say one year, into one task. The running
    sum only depends on the totals per (partition, order) value, so rows are first summed to those; the
    window runs on the totals and each row looks its result up. Both keys are integers with stated domains (years,
    quarters), which bounds the totals. The input is read twice, once to sum and once for the rows.
    """
    totals = df.groupBy(partition, order).agg(
        *[F.sum(source).alias(name) for name, source in measures.items()]
    )
    frame = Window.partitionBy(partition).orderBy(F.col(order).asc_nulls_last())
    running = totals.select(
        partition, order, *[F.sum(name).over(frame).alias(name) for name in measures]
    )
    return bounded_lookup(df, running, {partition: partition_domain, order: order_domain})


def latest_row(df: DataFrame, keys: Sequence[str], by: str, *tie_break: str) -> DataFrame:
    """WF2. The row with the largest `by` in each group; ties go to the larger tie-break columns.

    Filtering a row number to 1 lets Spark keep one row per group in every map task, before the shuffle.
    """
    order = [F.col(c).desc_nulls_last() for c in (by, *tie_break)]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where(F.col("_position") == 1).drop("_position")


def change_pct(df: DataFrame, order: str, measure: str, alias: str) -> DataFrame:
    """WF3. Change against the previous row in percent; null in the first row and after a zero.

    For results of one row per period: the window has a single partition.
    """
    frame = Window.orderBy(order)
    previous = F.lag(measure).over(frame)
    return df.withColumn(alias, (F.try_divide(F.col(measure), previous) - 1) * 100)


def last_by(df: DataFrame, *order: str) -> DataFrame:
    """WF4. The one row that comes last in the given order, as a top-1 without a full sort."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in order]).limit(1)
