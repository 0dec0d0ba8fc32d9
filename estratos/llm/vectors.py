"""Operator 12: exact top-k inner-product search with a KD-tree per shard.

Components are turned into floor(1024 * x), and scores are integer inner products. The vectors of a task are cut into
shards; each shard is split at medians of its widest dimension down to leaves, and every node has the tight bounding
box of its vectors. The inner product of a query with any vector of a box is at most the sum over dimensions of the
larger of q * low and q * high, so a box below a query's k-th best score holds no result.

A search takes the queries in blocks. First each block searches one shard; the k-th best scores found there go with the
block to all other shards. In a shard, a query walks the tree best box first, raises its k-th score as it goes, and
stops at the first box below it. Scores equal to the k-th are followed, so ties are resolved by id and nothing is lost.
The best k of all shards are the result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estratos.llm.common import read, written
from estratos.llm.search_units import ShardNumbers, list_of, meetings, only, slices_of

SHARD_VECTORS = 8192
SHARD_VALUES = 1 << 22
LEAF_VECTORS = 64
BLOCK_QUERIES = 512
#: A row of the index as one number: its shard's number (below 2^40) and its place in the shard.
PLACE_BITS = 23
SCALE = 1024
#: Sums of integers below this size are exact in doubles.
EXACT = 2.0**53

TREE = (
    "shard bigint, dim int, ids array<bigint>, points array<double>, first array<int>, last array<int>, child array<int>, "
    "low array<double>, high array<double>"
)


class Tree:
    """A KD-tree: node i covers the points `first[i]` up to `last[i]` in their new order and has its tight box in
    `low[i]` and `high[i]`; its children are `child[i]` and the next node, a leaf has -1."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = np.arange(len(points))
        self.first, self.last, self.child, self.low, self.high = [0], [len(points)], [-1], [None], [None]
        todo = [0]
        while todo:
            node = todo.pop()
            a, b = self.first[node], self.last[node]
            own = points[self.order[a:b]]
            self.low[node], self.high[node] = own.min(axis=0), own.max(axis=0)
            spread = self.high[node] - self.low[node]
            if b - a <= leaf or not spread.size or not spread.max() > 0:
                continue
            middle = (b - a) // 2
            cut = np.argpartition(own[:, int(spread.argmax())], middle)
            self.order[a:b] = self.order[a:b][cut]
            self.child[node] = len(self.first)
            for begin, end in ((a, a + middle), (a + middle, b)):
                todo.append(len(self.first))
                self.first.append(begin)
                self.last.append(end)
                self.child.append(-1)
                self.low.append(None)
                self.high.append(None)


def scaled(vectors: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """floor(1024 * x) of all components, end to end, and the length of each vector. What exceeds a double stays the
    largest double."""
    lengths = np.diff(vectors.offsets.to_numpy())
    with np.errstate(over="ignore"):
        values = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    return np.clip(values, -np.finfo(np.float64).max, np.finfo(np.float64).max), lengths


def padded(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Vectors of several lengths as a matrix; a component that a vector lacks counts as 0."""
    width = int(lengths.max()) if len(lengths) else 0
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


def _usable(vector: str) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return F.col(vector).isNotNull() & ~F.coalesce(odd, F.lit(False))


def build(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", shard_vectors: int = SHARD_VECTORS,
    leaf_vectors: int = LEAF_VECTORS,
) -> DataFrame:
    """The index: a row per shard with its ids and scaled vectors in leaf order and the nodes of its tree.

    Vectors that are null or hold null or non-finite components are left out. Nothing is shuffled: a task cuts what it
    reads into shards of bounded size.
    """

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, held, size = ShardNumbers(), [], 0

        def shard() -> pa.RecordBatch:
            ids = pa.concat_arrays([h[0] for h in held])
            points = padded(np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held]))
            tree = Tree(points, leaf_vectors)
            columns = [
                pa.array([numbers.next()], pa.int64()), pa.array([points.shape[1]], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(tree.order))),
                list_of(points[tree.order].ravel(), pa.float64()),
                *[list_of(np.array(x, np.int32), pa.int32()) for x in (tree.first, tree.last, tree.child)],
                *[list_of(np.concatenate(x), pa.float64()) for x in (tree.low, tree.high)],
            ]
            return pa.record_batch(columns, names=[part.split()[0] for part in TREE.split(", ")])

        for batch in batches:
            for at in range(0, len(batch), 256):
                piece = batch.slice(at, 256)
                values, lengths = scaled(piece.column(1))
                held.append((piece.column(0), values, lengths))
                size += len(piece)
                if size >= shard_vectors or sum(len(h[1]) for h in held) >= SHARD_VALUES:
                    yield shard()
                    held, size = [], 0
        if held:
            yield shard()

    chosen = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector")
    ).where(_usable("vector"))
    return written(chosen.mapInArrow(trees, TREE), "kd-trees")


def rows_as_queries(index: DataFrame, chosen: Column) -> DataFrame:
    """The index's own rows for which `chosen`, an expression over `query_id`, holds: `query`, `query_id`, `own_shard`,
    `own_place` and the scaled `vector`."""
    rows = index.select("shard", "dim", "points", F.posexplode("ids").alias("place", "query_id")).where(chosen)
    vector = F.slice("points", F.col("place") * F.col("dim") + 1, F.col("dim"))
    return rows.select(
        (F.shiftleft("shard", PLACE_BITS) + F.col("place")).alias("query"), "query_id", F.col("shard").alias("own_shard"),
        F.col("place").alias("own_place"), vector.alias("vector"),
    )


def _exact_scores(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of integers too large for doubles; what exceeds 64 bits becomes the nearest 64-bit number."""
    q = [int(x) for x in query]
    sums = [sum(int(x) * y for x, y in zip(p, q, strict=True)) for p in points]
    return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in sums], dtype=np.int64)


def best_first(
    shard: dict[str, np.ndarray], points: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray,
    floor: np.ndarray, k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its number, the places and the scores of its best `k` in this shard, none below its `floor`.

    `own` is the place of the query's own row, or -1. Equal scores go by id, null ids (the largest number) last.
    """
    dim = points.shape[1]
    low, high = shard["low"].reshape(-1, dim), shard["high"].reshape(-1, dim)
    largest = np.abs(queries).max(initial=0.0) * np.abs(points).max(initial=0.0) * max(dim, 1)
    exact = bool(largest < EXACT)
    with np.errstate(over="ignore", invalid="ignore"):
        bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T if exact else None
    for i, query in enumerate(queries):
        kth = floor[i]
        scores, places = np.zeros(0, np.int64), np.zeros(0, np.int64)
        heap = [(-bounds[i, 0] if exact else -math.inf, 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < kth:
                break
            child = shard["child"][node]
            if child >= 0:
                for c in (child, child + 1):
                    limit = bounds[i, c] if exact else math.inf
                    if limit >= kth:
                        heapq.heappush(heap, (-limit, int(c)))
                continue
            a, b = shard["first"][node], shard["last"][node]
            found = (points[a:b] @ query).astype(np.int64) if exact else _exact_scores(points[a:b], query)
            at = np.flatnonzero(found >= kth) + a
            if own[i] >= 0:
                at = at[at != own[i]]
            scores, places = np.concatenate((scores, found[at - a])), np.concatenate((places, at))
            if len(scores) > k:
                best = np.lexsort((ids[places], ~scores))[:k]
                scores, places = scores[best], places[best]
            if len(scores) == k:
                kth = max(kth, scores.min())
        if len(scores):
            yield i, places, scores


def _search(table: pa.Table, k: int) -> pa.Table:
    shard = {name: only(table, name) for name in ("first", "last", "child", "low", "high")}
    dim = table.column("dim")[0].as_py()
    id_list = table.column("ids").combine_chunks().values
    ids = id_list.fill_null(2**63 - 1).to_numpy(zero_copy_only=False)
    points = only(table, "points").reshape(len(ids), dim)
    packed = table.column("queries").combine_chunks().values
    keys, vectors = packed.field("query"), packed.field("vector")
    own = np.where(
        packed.field("own_shard").fill_null(-1).to_numpy(zero_copy_only=False) == table.column("shard")[0].as_py(),
        packed.field("own_place").fill_null(-1).to_numpy(zero_copy_only=False), -1,
    )
    values, lengths = vectors.flatten().to_numpy(zero_copy_only=False), np.diff(vectors.offsets.to_numpy())
    matrix = padded(values, lengths)
    queries = np.zeros((len(keys), dim))
    queries[:, : min(dim, matrix.shape[1])] = matrix[:, :dim]
    floors = dict(zip(*[x.to_pylist() for x in table.column("floors").combine_chunks().values.flatten()], strict=True))
    floor = np.array([floors.get(key, -(2**63)) for key in keys.to_pylist()], dtype=np.int64)
    hits = list(best_first(shard, points, ids, queries, own, floor, k))
    places = np.concatenate([p for _, p, _ in hits]) if hits else np.zeros(0, np.int64)
    which = np.repeat([i for i, _, _ in hits], [len(p) for _, p, _ in hits]).astype(np.int64)
    found = np.concatenate([s for _, _, s in hits]) if hits else np.zeros(0, np.int64)
    return pa.table(
        {
            "query": keys.take(pa.array(which)), "query_id": packed.field("query_id").take(pa.array(which)),
            "vec_id": id_list.take(pa.array(places)), "score": pa.array(found, pa.int64()),
        }
    )


def search(index: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """`query_id`, `rank` from 1, `vec_id` and `score` of the `k` best rows of the index for each query.

    `queries` has the columns of `rows_as_queries`; a query's own row is no candidate of it, its copies under any id
    are. Equal scores go to the smaller id, null ids last. Vectors of different lengths are compared over the
    components both have. Repeated ids are rows and queries of their own. Fewer than `k` candidates give fewer rows,
    an empty index or query set none.
    """
    queries = written(queries, "queries")
    count = max(1, math.ceil(queries.count() / BLOCK_QUERIES))
    blocks = queries.withColumn("block", F.pmod(F.xxhash64("query", F.lit(5)), F.lit(count)).cast("int"))
    blocks = blocks.groupBy("block").agg(
        F.collect_list(F.struct("query", "query_id", "own_shard", "own_place", "vector")).alias("queries")
    )
    blocks, slices = written(blocks, "query-blocks"), slices_of(index)
    pairs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    schema = "query bigint, query_id bigint, vec_id bigint, score bigint"

    def found(shards: DataFrame, packed: DataFrame) -> DataFrame:
        return meetings(shards, packed, slices).applyInArrow(lambda table: _search(table, k), schema)

    none = F.array().cast("array<struct<query:bigint,floor:bigint>>")
    # The shard a block searches first. Its k-th best scores bound what the other shards have to show.
    seeds = written(
        pairs.select("shard", "block").groupBy("block").agg(F.min_by("shard", F.xxhash64("shard", "block")).alias("shard")),
        "seeds",
    )
    first = written(found(index.join(seeds, "shard"), blocks.withColumn("floors", none)), "seeded")
    floors = first.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") == k)
    floors = floors.join(queries.select("query"), "query").withColumn(
        "block", F.pmod(F.xxhash64("query", F.lit(5)), F.lit(count)).cast("int")
    )
    floors = floors.groupBy("block").agg(F.collect_list(F.struct("query", "floor")).alias("floors"))
    bounded = blocks.join(floors, "block", "left").withColumn("floors", F.coalesce("floors", none))
    rest = pairs.join(seeds, ["shard", "block"], "left_anti")
    every = first.unionByName(found(rest, bounded))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op12_kd_tree_search(spark, sf_dir: str) -> DataFrame:
    """The ten best rows of `embeddings` for each of its rows whose vec_id is divisible by 100."""
    index = build(read(spark, sf_dir, "embeddings"))
    return search(index, rows_as_queries(index, F.col("query_id") % 100 == 0), 10)


ORACLE = """
with held as (
  select row_number() over () as r, vec_id, embedding from embeddings),
scaled as (
  select r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from held
  where embedding is not null and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), true)),
scored as (
  select q.r, q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from scaled q join scaled c on q.r <> c.r where q.vec_id % 100 = 0)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by r order by score desc, vec_id) as rank from scored) where rank <= 10
"""
