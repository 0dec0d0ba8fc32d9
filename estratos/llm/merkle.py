"""Operator 13: Merkle manifest of a data set, with proofs by descent through content-addressed records.

A document's leaf is a hash over its columns. The leaves of each language, in order of id, are the bottom of a tree in
which every `FAN` consecutive nodes have their hash above them; the trees' roots, in order of language, are the bottom
of one more tree, whose root stands for the whole data set.

Each inner node is a record, its digest with the digests of its children, and the records are all that a proof needs. A
request for a leaf starts at the root's digest, looks up its record, chooses the child that the next digit of the leaf's
rank names, collects the other children, and goes on with the chosen digest. At the leaf the collected segments are
reversed, which puts them in order from leaf to root. Requests with the same digits so far are one row, so the root is
asked for once however many leaves are wanted, and a proof exists as a whole only where it is folded.

Ranks come from a range partitioning by (language, id), whose partitions are numbered within and then offset, so that
no task holds a whole language.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estratos.llm.common import read, written

FAN = 8
#: Levels that are built at once: a group of FAN ** LEVELS nodes is a row.
LEVELS = 3
RECORDS = "array<struct<digest:string,children:array<string>>>"


def digest(*parts: Column) -> Column:
    """H: the lowercase hex sha256 of the parts end to end."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def ranked(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """`df` with `position`, gapless from 0 in ascending order of the columns, nulls first."""
    keys = [F.col(name).asc_nulls_first() for name in order]
    parted = written(df.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = parted.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(*keys)) - 1
    placed = parted.withColumn("within", within).join(starts, "part")
    return placed.withColumn("position", F.col("start") + F.col("within")).drop("part", "within", "start")


def leaves(docs: DataFrame, columns: Sequence[str], lang: str, order: str, changed: Column, as_changed: dict[str, Column]) -> DataFrame:
    """`lang`, `id`, `leaf`, `rank` in the tree of its language, and `told`, the leaf as it is told for the check: where
    `changed` holds, with the columns `as_changed` in place of the true ones.

    Rows that are equal in language and id are in order of their leaves.
    """
    true = digest(*[field(F.col(f"`{name}`")) for name in columns])
    told = digest(*[field(as_changed.get(name, F.col(f"`{name}`"))) for name in columns])
    hashed = docs.select(
        F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{order}`").alias("id"), true.alias("leaf"),
        F.when(F.coalesce(changed, F.lit(False)), told).alias("told"),
    )
    placed = written(ranked(hashed, ["lang", "id", "leaf", "told"]), "leaves")
    first = written(placed.groupBy("lang").agg(F.min("position").alias("first"), F.count("*").alias("size")), "languages")
    first = written(ranked(first, ["lang"]).withColumnRenamed("position", "tree"), "trees")
    joined = placed.join(first.withColumnRenamed("lang", "of"), F.col("lang").eqNullSafe(F.col("of")))
    return joined.select(
        "lang", "id", "leaf", F.coalesce("told", "leaf").alias("told"), "tree", "size",
        (F.col("position") - F.col("first")).alias("rank"),
    )


def parents(nodes: Column) -> Column:
    """The records above an array of digests: one for each run of `FAN`."""
    runs = F.transform(F.sequence(F.lit(1), F.size(nodes), F.lit(FAN)), lambda at: F.slice(nodes, at, FAN))
    return F.transform(runs, lambda run: F.struct(digest(F.array_join(run, "")).alias("digest"), run.alias("children")))


def grow(bottom: DataFrame, largest: int) -> tuple[DataFrame, DataFrame]:
    """The records and the roots of trees given by `tree`, `rank`, `digest` and `size`, the number of the tree's leaves,
    which is at most `largest`.

    A record is a `digest` with its `children`; the roots are `tree`, `digest` and `height`, the number of levels above
    the leaves. A round works `LEVELS` levels up within groups of consecutive nodes, each group a row of bounded size,
    and writes what it makes.
    """
    width = FAN**LEVELS
    level = bottom.select("tree", "rank", "digest", "size", F.lit(0).alias("height"))
    roots, records = [level.where("size = 1").select("tree", "digest", "height")], []
    while largest > 1:
        group = level.where("size > 1").groupBy("tree", F.floor(F.col("rank") / width).cast("long").alias("rank")).agg(
            F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("own"), F.first("size").alias("size"),
            F.first("height").alias("height"),
        )
        nodes, size, height = F.col("own.digest"), F.col("size"), F.col("height")
        group = group.withColumn("made", F.array().cast(RECORDS))
        for _ in range(LEVELS):
            more = size > 1
            group = group.withColumn("parents", F.when(more, parents(nodes)).otherwise(F.array().cast(RECORDS)))
            group = group.withColumns(
                {
                    "made": F.concat("made", "parents"),
                    "nodes": F.when(more, F.col("parents.digest")).otherwise(nodes),
                    "left": F.when(more, F.ceil(size / FAN).cast("long")).otherwise(size),
                    "up": F.when(more, height + 1).otherwise(height),
                }
            )
            nodes, size, height = F.col("nodes"), F.col("left"), F.col("up")
        kept = written(
            group.select("tree", "rank", F.col("nodes")[0].alias("digest"), F.col("left").alias("size"), F.col("up").alias("height"), "made"),
            "level",
        )
        records.append(kept.select(F.inline("made")))
        level = kept.drop("made")
        roots.append(level.where("size = 1").select("tree", "digest", "height"))
        largest = -(-largest // width)
    known = reduce(DataFrame.unionAll, records) if records else level.select("digest", F.array("digest").alias("children"))
    # Equal runs anywhere have one digest, so one record serves them all.
    known = known.groupBy("digest").agg(F.first("children").alias("children"))
    return written(known, "records"), reduce(DataFrame.unionAll, roots)


def descend(records: DataFrame, requests: DataFrame, depth: int) -> DataFrame:
    """Follow requests `tree`, `subroot`, `digest`, `prefix` (the digits so far as a number), `height` (levels left) and
    `path` down to the records above the leaves: `tree`, `subroot`, `prefix`, `path` and `children`.

    `depth` is the largest height. Requests of lower trees join in when the others have come down to their height, so
    all end together; one that begins at a leaf has that leaf as its only child, and its path is whole.
    """
    state = "tree", "subroot", "digest", "prefix", "height", "path"
    step = None
    for height in range(depth, 0, -1):
        joining = requests.where(F.col("height") == height).select(*state)
        step = joining if step is None else step.unionAll(joining)
        looked_up = step.join(records, "digest").select(*[name for name in state if name != "digest"], "children")
        if height > 1:
            step = chosen(looked_up).select(
                "tree", "subroot", "digest", (F.col("prefix") * FAN + F.col("digit")).alias("prefix"),
                (F.col("height") - 1).alias("height"), "path",
            )
    alone = requests.where("height = 0").select("tree", "subroot", "prefix", "path", F.array("digest").alias("children"))
    return alone if step is None else alone.unionAll(looked_up.select("tree", "subroot", "prefix", "path", "children"))


def segment(children: Column, digit: Column) -> Column:
    """What a choice leaves: the children left of the chosen one, and those right of it."""
    return F.struct(
        F.array_join(F.slice(children, F.lit(1), digit), "").alias("left"),
        F.array_join(F.slice(children, digit + 2, F.lit(FAN)), "").alias("right"),
    )


def chosen(looked_up: DataFrame) -> DataFrame:
    """A row for each child of each looked-up record, with its digit, its digest and its segment added to the path."""
    children = F.col("children")
    each = looked_up.select("*", F.posexplode(children).alias("digit", "digest"))
    return each.withColumn("path", F.concat("path", F.array(segment(children, F.col("digit")))))


def ended(path: Column, size: Column, children: Column, digit: Column) -> Column:
    """The whole path from leaf to root: a tree of one leaf has no level of its own."""
    return F.reverse(F.when(size == 1, path).otherwise(F.concat(path, F.array(segment(children, digit)))))


def proofs(of_leaves: DataFrame) -> DataFrame:
    """For each row of `leaves`: `id`, `leaf`, `subroot`, `root`, `proof_sha256`, `folded_root` and `verified`."""
    of_leaves = written(of_leaves, "ranked-leaves")
    largest = of_leaves.agg(F.max("size")).first()[0] or 0
    records, subroots = grow(of_leaves.withColumnRenamed("leaf", "digest"), largest)
    subroots = written(subroots, "subroots")
    trees = subroots.agg(F.count("*").alias("n"), F.max("height").alias("height")).first()
    bottom = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), "digest", F.lit(trees["n"]).alias("size"))
    top_records, top = grow(bottom, trees["n"])
    root = top.first()
    if root is None:
        root = {"digest": None, "height": 0}
    none = F.array().cast("array<struct<left:string,right:string>>")
    top_height, zero = root["height"], F.lit(0).cast("long")
    start = top.select("tree", F.col("digest").alias("subroot"), "digest", zero.alias("prefix"), "height", none.alias("path"))
    reached = chosen(descend(top_records, start, top_height)).select(
        (F.col("prefix") * FAN + F.col("digit")).alias("tree"), F.col("digest").alias("subroot"), "digest", zero.alias("prefix"),
        "path" if top_height else none.alias("path"),
    )
    # A subroot's place below the root is its tree's number; its height says how many digits a rank has there.
    requests = written(reached.join(subroots.select("tree", "height"), "tree"), "requests")
    found = descend(records, requests, trees["height"] or 0)
    runs = of_leaves.groupBy("tree", F.floor(F.col("rank") / FAN).cast("long").alias("prefix")).agg(
        F.collect_list(F.struct("id", "leaf", "told", F.pmod("rank", F.lit(FAN)).cast("int").alias("digit"))).alias("own"),
        F.first("size").alias("size"),
    )
    met = runs.join(found, ["tree", "prefix"])
    each = met.select(F.explode("own").alias("own"), "size", "path", "children", "subroot").select(
        "own.*", "subroot", ended(F.col("path"), F.col("size"), F.col("children"), F.col("own.digit")).alias("path")
    )
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = F.aggregate("path", F.col("told"), lambda node, s: digest(s["left"], node, s["right"]))
    return each.select(
        "id", "leaf", "subroot", F.lit(root["digest"]).cast("string").alias("root"), digest(siblings).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def manifest(docs: DataFrame) -> DataFrame:
    """The manifest of documents, each checked against its proof, with every third one (by crc32 of the id) lower-cased
    before the check.

    Null ids come first in their language, a null language is a tree of its own and comes first; a row with a null id is
    not changed. Repeated rows are leaves of their own. Other columns play no part. An empty table gives no rows.
    """
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    of_leaves = leaves(docs, COLUMNS, "lang", "doc_id", crc % 3 == 0, {"text": lowered})
    return proofs(of_leaves).withColumnRenamed("id", "doc_id")


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """The manifest of all documents with a proof for each."""
    return manifest(read(spark, sf_dir, "documents"))


LEVELS_OF_SQL = 6


def _level(kind: str, k: int) -> str:
    """SQL: the nodes of level k + 1 of all trees, and what each node of level k has beside it in its run."""
    run = "over (partition by tree, i // 8 order by i rows between"
    return f"""
{kind}_run{k} as (
  select tree, i, i // 8 as run, d, count(*) over (partition by tree) as n,
         string_agg(d, '') {run} unbounded preceding and 1 preceding) as before,
         string_agg(d, '') {run} 1 following and unbounded following) as after
  from {kind}_level{k}),
{kind}_side{k} as (
  select tree, i, n > 1 as real, case when n > 1 then coalesce(before, '') else '' end as l,
         case when n > 1 then coalesce(after, '') else '' end as r from {kind}_run{k}),
{kind}_level{k + 1} as (
  select tree, run as i, case when any_value(n) > 1 then sha256(string_agg(d, '' order by i)) else any_value(d) end as d
  from {kind}_run{k} group by tree, run)"""


def _fold(kind: str, k: int, before: str, tree: str, place: str) -> str:
    """SQL: the told leaf's node and its proof one level further up."""
    return f"""
{kind}_fold{k} as (
  select x.* exclude (told, proof), case when real then sha256(l || told || r) else told end as told, proof || l || r as proof
  from {before} x join {kind}_side{k} s on s.tree = x.{tree} and s.i = x.{place} // {8**k})"""


_UP = range(LEVELS_OF_SQL)
_FIELD = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BITS = "list_reduce(list_prepend({0}, [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda x, _: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)"
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)), lambda crc, byte: "
    + _BITS.format("xor(crc, byte)") + "), 4294967295)"
)
_TREES = {kind: ",".join(_level(kind, k) for k in _UP) for kind in ("low", "top")}
_FOLDS = ",".join(
    [_fold("low", k, f"low_fold{k - 1}" if k else "start", "tree", "i") for k in _UP]
    + [_fold("top", k, f"top_fold{k - 1}" if k else f"low_fold{LEVELS_OF_SQL - 1}", "zero", "tree") for k in _UP]
)

#: Six levels for each tree, which is enough for 8 ** 6 documents a language.
ORACLE = f"""
with hashed as (
  select doc_id, lang, sha256({" || ".join(_FIELD.format(c) for c in COLUMNS)}) as leaf,
         sha256({" || ".join(_FIELD.format(_LOWERED if c == "text" else c) for c in COLUMNS)}) as lowered,
         coalesce({_CRC} % 3 = 0, false) as tampered from documents),
leaf as (
  select *, dense_rank() over (order by lang nulls first) - 1 as tree,
         row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i from hashed),
low_level0 as (select tree, i, leaf as d from leaf),{_TREES["low"]},
top_level0 as (select 0 as tree, tree as i, d from low_level{LEVELS_OF_SQL} where i = 0),{_TREES["top"]},
start as (
  select doc_id, leaf, tree, i, 0 as zero, '' as proof, case when tampered then lowered else leaf end as told from leaf),
{_FOLDS},
root as (select d as root from top_level{LEVELS_OF_SQL})
select doc_id, leaf, d as subroot, root, sha256(proof) as proof_sha256, told as folded_root, told = root as verified
from top_fold{LEVELS_OF_SQL - 1} f join low_level{LEVELS_OF_SQL} s on s.tree = f.tree cross join root
"""
