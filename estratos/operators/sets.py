"""Concatenation and set difference."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def concat_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """SO1. Rows of all frames, columns matched by name, absent ones null, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unseen(current: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """SO2. Key values listed now that were not seen before."""
    return current.select(key).distinct().join(seen.select(key).distinct(), key, "left_anti")


def all_seen(current: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """SO2. The new cursor: key values seen before or listed now."""
    return current.select(key).union(seen.select(key)).distinct()
