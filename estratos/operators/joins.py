"""Join and look-up operators."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The most rows a side may have, by proof or by a check, to be sent to every executor.
BROADCAST_ROWS = 200_000


def bounded_lookup(big: DataFrame, small: DataFrame, domains: Mapping[str, tuple[int, int]]) -> DataFrame:
    """`big` with the other columns of `small`, which has one row for each key that `big` holds, the keys being integers.

    `small` becomes one value of the plan, a scalar subquery, and the look-up an expression on the rows of `big`: those
    are read once, and neither shuffled nor joined. Keys inside their domains are places of an array, at most the
    product of the domain sizes. Keys outside (null, or a corrupt year) are few and go through a map; more than
    `BROADCAST_ROWS` of them are an error that says what to do. If the domains are too large to prove a useful bound,
    the two are joined by shuffle, null keys with null keys.
    """
    keys, values = list(domains), [name for name in small.columns if name not in domains]
    if math.prod(high - low + 1 for low, high in domains.values()) > BROADCAST_ROWS:
        return equal_keys(big, small, keys)
    inside, place = F.lit(True), F.lit(0).cast("int")
    for key, (low, high) in domains.items():
        inside = inside & F.coalesce(F.col(key).between(low, high), F.lit(False))
        place = place * (high - low + 1) + (F.col(key) - low).cast("int")
    place = F.when(inside, place)
    name = F.concat_ws("/", *[F.coalesce(F.col(key).cast("string"), F.lit("-")) for key in keys])
    entry = F.struct(*values)
    table = small.agg(
        F.min(place).alias("low"), F.max(place).alias("high"),
        F.map_from_entries(F.collect_list(F.when(inside, F.struct(place, entry)))).alias("near"),
        F.map_from_entries(F.collect_list(F.when(~inside, F.struct(name, entry)))).alias("far"),
    )
    advice = f"more than {BROADCAST_ROWS} keys lie outside {dict(domains)}; state larger domains to join them by shuffle"
    error = F.raise_error(F.lit(advice)).cast(table.schema["far"].dataType)
    places = F.transform(F.sequence("low", "high"), lambda at: F.try_element_at("near", at))
    others = F.when(F.size("far") > BROADCAST_ROWS, error).otherwise(F.col("far"))
    found = table.select(F.struct("low", places.alias("near"), others.alias("far"))).scalar()
    # Named before it is used, so that it is one subquery and not one for each use.
    row = F.when(inside, F.get("_all.near", place - F.col("_all.low"))).otherwise(F.try_element_at("_all.far", name))
    looked_up = big.withColumn("_all", found).withColumn("_found", row)
    return looked_up.select(*big.columns, *[F.col("_found")[value].alias(value) for value in values])


def equal_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys of which null equals null."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = reduce(
        lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    )
    return left.join(renamed, condition, "inner").drop(*[f"_right_{key}" for key in keys])


def matching_years(left: DataFrame, right: DataFrame) -> DataFrame:
    """J1. Inner join of two yearly results; both are one row per year, AQE picks the strategy."""
    return left.join(right, "year", "inner")


def lookup_or_default(
    df: DataFrame, key: str, table: DataFrame, table_key: str, defaults: Mapping[str, object],
    fold_case: bool = False, fixed_size: bool = False,
) -> DataFrame:
    """J2. Left look-up of the `defaults` columns by a text key; unknown keys get the defaults.

    Where several keys of `table` are equal, as can happen with folded case, the one that comes first in order of the
    key counts, so no row of `df` is doubled. `fixed_size` states that it is a constant of the library with
    one row per folded key, which may be broadcast as it is; otherwise Spark decides by the measured size.
    """
    fold = F.lower if fold_case else (lambda c: c)
    found = [F.col(c).alias(f"_found_{c}") for c in defaults]
    right = table.select(fold(F.col(table_key)).alias("_lookup_key"), F.col(table_key).alias("_exact"), *found)
    if fixed_size:
        right = F.broadcast(right.drop("_exact"))
    else:
        one = F.min_by(F.struct(*[f"_found_{c}" for c in defaults]), "_exact").alias("_one")
        right = right.groupBy("_lookup_key").agg(one).select("_lookup_key", "_one.*")
    joined = df.join(right, fold(df[key]) == F.col("_lookup_key"), "left")
    return joined.select(
        *[df[c] for c in df.columns],
        *[F.coalesce(F.col(f"_found_{c}"), F.lit(v)).alias(c) for c, v in defaults.items()],
    )


def with_calendar(fact: DataFrame, calendar: DataFrame, columns: Sequence[str]) -> DataFrame:
    """J4. Add calendar attributes of the month to a fact on `period_date`.

    The calendar is daily, so it is first reduced to one row per month; Spark broadcasts it by its measured size.
    """
    monthly = calendar.groupBy("period_date").agg(*[F.min(c).alias(c) for c in columns])
    return fact.join(monthly, "period_date", "inner")


def missing_periods(calendar: DataFrame, fact: DataFrame, column: str = "period_date") -> DataFrame:
    """J5. Calendar periods without any fact row.

    The fact is reduced to its distinct periods in the map tasks before it is shuffled.
    """
    expected = calendar.select(column).distinct()
    return expected.join(fact.select(column).distinct(), column, "left_anti")


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """J6. Key values of the child that the parent lacks, with the number of child rows; nulls pass.

    Child rows are counted per key first, so a key with very many rows costs one row in the join.
    """
    used = child.where(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("num_rows"))
    known = parent.select(F.col(parent_key).alias(child_key))
    return used.join(known, child_key, "left_anti")


def orphan_rows(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """J6. The child rows themselves whose key the parent lacks; nulls pass."""
    known = parent.select(F.col(parent_key).alias(child_key))
    return child.where(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")
