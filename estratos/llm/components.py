"""Connected components of a graph given as edges, by alternating large and small stars.

Each round is two group-bys with a join back, written to the shared scratch folder; a node with very many neighbours
is one pre-aggregated row on one side of a join that adaptive execution may split on the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estratos.llm.common import written


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """`node` and `component`, the smallest node it reaches, for each node that has an edge.

    `edges` has the long columns `a` and `b`. Loops and nulls are left out, repeated edges do not matter, and a table
    without edges gives an empty result.
    """
    linked = edges.where("a is not null and b is not null and a <> b")
    current = written(
        linked.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = None
    while (after := _signature(current)) != state:
        state = after
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(below, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionAll(below.select("a", F.col("m").alias("b"))).distinct()
        current = written(small, "edges")
    roots = current.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
