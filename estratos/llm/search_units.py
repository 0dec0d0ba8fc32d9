"""Search of a query set against an index of shards: each shard meets each block of queries, one such pair at a time.

A shard is one row of the index, a block is one row of packed queries. Blocks are repeated once per slice of the
shards, so that a pair finds its block by an equality join that is spread over all tasks also when there is only one
block, and each pair is a group of its own, so that a task holds one shard and one block at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F


def slices_of(index: DataFrame) -> int:
    """How many slices the shards of an index are dealt to: no more than there are shards or shuffle partitions."""
    wanted = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(wanted, index.count()))


def meetings(shards: DataFrame, blocks: DataFrame, slices: int) -> GroupedData:
    """The pairs of `shards` (`shard`, `block` and more) and `blocks` (`block` and more), a group for each."""
    placed = shards.withColumn("slice", F.pmod(F.xxhash64("shard"), F.lit(slices)).cast("int"))
    spread = blocks.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    # Merged, because copies for every slice are no less to send than the shards' own partitions, and must not be broadcast.
    return placed.join(spread.hint("merge"), ["block", "slice"]).groupBy("block", "slice", "shard")


class ShardNumbers:
    """Numbers for the shards that a task makes: the same when the task runs again, and no other task's."""

    def __init__(self):
        context = TaskContext.get()
        self._next = (context.partitionId() if context is not None else 0) << 20

    def next(self) -> int:
        self._next += 1
        return self._next - 1


def list_of(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A column of one row that holds all `values`."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def only(table: pa.Table, name: str) -> np.ndarray:
    """The values of a list column of a table of one row; nulls become NaN."""
    return table.column(name).combine_chunks().values.to_numpy(zero_copy_only=False)
