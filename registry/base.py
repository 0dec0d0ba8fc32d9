"""Registration of queries with the inventory ids they cover and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    ids: tuple[str, ...]
    run: Query
    oracle: str | None


ENTRIES: dict[str, Entry] = {}


def register(name: str, ids: str, oracle: str | None, run: Query | None = None):
    """Add a query; usable as a decorator. `ids` is a space-separated list of inventory ids."""

    def add(fn: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(name, tuple(ids.split()), fn, oracle)
        return fn

    return add if run is None else add(run)
