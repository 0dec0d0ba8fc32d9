"""Operator 2: uniform shuffle into shards of exact size through a hypergeometric communication matrix.

Rows are dealt into blocks by a hash. For each block the exact number of its rows that go to each shard is drawn from
the multivariate hypergeometric law (the communication matrix), so shard sizes are fixed before a row moves and the
outcome is a uniform shuffle. Rows are permuted within their block, cut by the drawn counts, exchanged, and permuted
again within the shard, piece by piece, so no task holds a whole shard.

The matrix has at most `MAX_BLOCKS` times `shards` numbers; only it and the rows per block pass the driver.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estratos.llm.common import read, row_hash

ROWS_PER_BLOCK = 1024
MAX_BLOCKS = 1 << 16
_NUMPY_LIMIT = 10**9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of `drawn` rows are good ones; exact also beyond the sizes numpy takes."""
    if drawn == 0 or good == 0:
        return 0
    if bad == 0:
        return drawn
    if good + bad < _NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, drawn))
    # Two binomials given their sum follow the hypergeometric law, whatever the common probability.
    share = drawn / (good + bad)
    while True:
        a, b = rng.binomial(good, share, 65536), rng.binomial(bad, share, 65536)
        hit = np.flatnonzero(a + b == drawn)
        if len(hit):
            return int(a[hit[0]])


def communication_matrix(block_rows: list[int], shard_rows: list[int], seed: int) -> list[list[int]]:
    """For each block the rows it sends to each shard; row sums and column sums are the given ones."""
    rng, left, matrix = np.random.default_rng(seed), list(shard_rows), []
    for rows in block_rows:
        sent, total, want = [], sum(left), rows
        for shard, free in enumerate(left):
            total -= free
            sent.append(want if shard == len(left) - 1 else hypergeometric(rng, free, total, want))
            want -= sent[-1]
        left = [a - b for a, b in zip(left, sent, strict=True)]
        matrix.append(sent)
    return matrix


def shuffle_into_shards(docs: DataFrame, shards: int = 16, seed: int = 17) -> DataFrame:
    """All rows of `docs` with `shard` (0 up to shards - 1) and `slot` (0, 1, ... within the shard).

    Shards differ by one row at most; each assignment of rows to shards and slots that has these sizes is equally
    likely over the seeds, and one seed always gives the same. Keys are hashes of whole rows with nulls as values of
    their own, so null or repeated ids are spread too; rows equal in every column are interchangeable. Columns named
    `shard` or `slot` are replaced. An empty table gives an empty result.
    """
    kept = [name for name in docs.columns if name not in ("shard", "slot")]
    n = docs.count()
    blocks = min(MAX_BLOCKS, max(1, math.ceil(n / ROWS_PER_BLOCK)))
    pieces = max(1, math.ceil(blocks / shards))
    keyed = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in kept]).alias("row"),
        F.pmod(row_hash(docs, seed), F.lit(blocks)).cast("int").alias("block"),
        row_hash(docs, seed + 1).alias("first_key"),
        row_hash(docs, seed + 2).alias("second_key"),
    )
    counted = dict(keyed.groupBy("block").count().collect())
    order = sorted(counted)
    matrix = communication_matrix(
        [counted[b] for b in order], [n // shards + (s < n % shards) for s in range(shards)], seed
    )
    cuts = docs.sparkSession.createDataFrame(
        [(block, np.cumsum(sent).tolist()) for block, sent in zip(order, matrix, strict=True)],
        T.StructType([T.StructField("block", T.IntegerType()), T.StructField("cuts", T.ArrayType(T.LongType()))]),
    )
    in_block = Window.partitionBy("block").orderBy("first_key", "second_key")
    dealt = (
        keyed.withColumn("rank", F.row_number().over(in_block))
        .join(cuts, "block")
        .select(
            "row", "first_key", "second_key",
            F.size(F.filter("cuts", lambda cut: cut < F.col("rank"))).alias("shard"),
            F.pmod(F.shiftright("second_key", 20), F.lit(pieces)).cast("int").alias("piece"),
        )
    )
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "piece").agg(F.count("*").alias("rows")).select(
        "shard", "piece", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base")
    )
    in_piece = Window.partitionBy("shard", "piece").orderBy("second_key", "first_key")
    placed = dealt.withColumn("place", F.row_number().over(in_piece)).join(starts, ["shard", "piece"])
    return placed.select(
        *[F.col("row")[name].alias(name) for name in kept], "shard", (F.col("base") + F.col("place") - 1).alias("slot")
    )


def op2_hypergeometric_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards by the law `rows`; copies are spread like other rows, a null text has no bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return shuffle_into_shards(read(spark, sf_dir, "documents"), 16).select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
