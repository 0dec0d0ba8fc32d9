"""Operator 9: mixing sources to target weights through a multivariate-hypergeometric splitting tree.

Every source has a target in words. Its rows are dealt by hash into blocks, the blocks are permuted, and the mix draws
whole passes over all blocks and then blocks from the front until the target is met; only the last block is taken row
by row. What a row too long for it leaves open there is drawn, smallest levels of size first, from the rows that fit
in the rest of that block and in the blocks behind it; then one row drawn in that block is exchanged for one that is
not, or for none, if that brings the source nearer to its target. So each source has an exact quota of block draws. A binary tree splits the quotas among the output shards: a
node sends an exact number of its draws to the left, and how many of them belong to which source follows the
multivariate hypergeometric law. Each shard then owns disjoint runs of the permuted block draws, and its rows have a
random key by which they are shuffled within the shard.

All work on rows is DataFrame operations. The driver sees one row per source: its quota.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estratos.llm.common import read, written
from estratos.llm.sharding import hypergeometric

WEIGHTS = (5, 2, 1)
ROWS_PER_BLOCK = 1024
MOST_REPEATS = 3
WORD = "[^\\x20\\x09-\\x0D]+"


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source: `source`, `rows`, `source_size` and `target`.

    `sizes` has `source` and `size`. Sources in order of their code points, null last, weigh as `weights` says, over
    and over; they share the sum of all sizes by weight. No target is above `most` times its source's size, and what
    is cut off is shared again by weight: with sources in order of size over weight, those at their limit come first.
    """
    per_source = sizes.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    by_name, everything = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = per_source.withColumn("weight", weight).withColumn("limit", F.col("source_size") * most)
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "weight", F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(earlier), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    )
    leveled = ranked.withColumn("level", level)
    below = F.when(F.col("limit") / F.col("weight") > F.col("level"), F.col("level"))
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, 0)
    shared = leveled.withColumn("shared", F.first(below, ignorenulls=True).over(upto))
    target = F.coalesce(F.col("weight") * F.col("shared"), F.col("limit").cast("double"))
    return shared.select("source", "rows", "source_size", target.alias("target"))


def split_quotas(quotas: list[int], shards: int, seed: int) -> list[list[int]]:
    """How many of each source's block draws go to each shard: [source][shard], shard totals one apart at most."""
    rng = np.random.default_rng(seed)

    def node(own: list[int], width: int) -> list[list[int]]:
        if width == 1:
            return [own]
        left_width = width // 2
        left_total = sum(own) * left_width // width
        left, rest, wanted = [], sum(own), left_total
        for quota in own:
            rest -= quota
            left.append(hypergeometric(rng, quota, rest, wanted))
            wanted -= left[-1]
        right = [a - b for a, b in zip(own, left, strict=True)]
        return node(left, left_width) + node(right, width - left_width)

    return [list(column) for column in zip(*node(quotas, shards), strict=True)]


def _number(digest: Column) -> Column:
    """The first 32 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _first_draw(rows: DataFrame) -> DataFrame:
    """Adds `again`, rows of the last pass in order of digests up to `needs` words of their block, `missing`, and
    `fills`: in the block that is drawn in part, the one row whose size comes closest to what is missing goes in too."""
    whole = Window.partitionBy("source", "block")
    within = whole.orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("size").over(within))
    rows = rows.withColumn("again", (F.col("needs") > 0) & (F.col("upto") <= F.col("needs")))
    missing = F.col("needs") - F.coalesce(F.max(F.when(F.col("again"), F.col("upto"))).over(whole), F.lit(0))
    rows = rows.withColumn("missing", missing).withColumn("off", F.abs(F.col("size") - F.col("missing")))
    closest = F.row_number().over(whole.orderBy(F.col("again"), "off", "digest")) == 1
    return rows.withColumn("fills", ~F.col("again") & closest & (F.col("off") < F.col("missing")))


def _second_draw(rows: DataFrame) -> DataFrame:
    """Adds `more`: of the rows the first draw left and that fit, all of lower levels than `level`, those of this level
    in order of digests up to `carry` words of their block, and the row that comes closest to what is then missing."""
    whole = Window.partitionBy("source", "block")
    within = whole.orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    fits = _fits(F.col("short"))
    lower, level = fits & (_level() < F.col("level")), fits & (_level() == F.col("level"))
    rows = rows.withColumn("lower", F.coalesce(lower, F.lit(False))).withColumn("on_level", F.coalesce(level, F.lit(False)))
    rows = rows.withColumn("upto_level", F.sum(F.when(F.col("on_level"), F.col("size"))).over(within))
    rows = rows.withColumn("walked", F.col("on_level") & (F.col("upto_level") <= F.col("carry")))
    rows = rows.withColumn("gap", F.col("carry") - F.coalesce(F.max(F.when(F.col("walked"), F.col("upto_level"))).over(whole), F.lit(0)))
    rows = rows.withColumn("taken_so_far", F.col("again") | F.col("lower") | F.col("walked"))
    rows = rows.withColumn("beside", F.abs(F.col("size") - F.col("gap")))
    closest = F.row_number().over(whole.orderBy(F.col("taken_so_far"), "beside", "digest")) == 1
    partly = (F.col("carry") > 0) & (F.col("carry") < F.col("level_words"))
    closes = partly & ~F.col("taken_so_far") & closest & (F.col("beside") < F.col("gap"))
    return rows.withColumn("more", F.col("lower") | F.col("walked") | F.coalesce(closes, F.lit(False)))


def _fits(short: Column) -> Column:
    """Rows the first draw left, in its last block and behind it, that are not longer than what is missing."""
    return ~F.col("again") & (F.col("needs") < F.col("words")) & (F.col("size") > 0) & (F.col("size") <= short)


def _level() -> Column:
    """One more for each doubling of the size."""
    return F.length(F.bin(F.col("size")))


def _further(sizes: DataFrame, ordered: DataFrame) -> DataFrame:
    """What the second draw needs, for each block of the sources whose first draw does not end on the target.

    `from`, `in_block`, `short` (words missing without the row that fills), `level`, `carry`, `level_words` and
    `visited`. Sources that the second draw brings no nearer are left out.
    """
    slim = ordered.select(F.col("source").alias("from"), F.col("block").alias("in_block"), "words", "at", "needs")
    same = F.col("source").eqNullSafe(F.col("from")) & (F.col("block") == F.col("in_block"))
    part = slim.where((F.col("needs") > 0) & (F.col("needs") < F.col("words")))
    first = _first_draw(sizes.join(part, same)).groupBy("source").agg(
        F.max("missing").alias("short"),
        (F.max("missing") - F.sum(F.when(F.col("fills"), F.col("size")).otherwise(0))).alias("miss"),
    )
    far = written(first.where(F.col("miss") != 0).withColumnRenamed("source", "of"), "far")
    open_blocks = slim.where(F.col("needs") < F.col("words")).join(far, F.col("from").eqNullSafe(F.col("of"))).drop("of")
    rows = _first_draw(sizes.join(open_blocks, same))
    left = written(rows.where(_fits(F.col("short"))).select("from", "in_block", "at", "short", "size", _level().alias("on")), "left")

    # The lowest level that fills the gap together with those below it; where none does, one above all.
    by_level = Window.partitionBy("from").orderBy("on")
    levels = left.groupBy("from", "short", "on").agg(F.sum("size").alias("n")).withColumn("upto", F.sum("n").over(by_level))
    enough = F.col("upto") >= F.col("short")
    chosen = levels.groupBy("from").agg(
        F.coalesce(F.min(F.when(enough, F.col("on"))), F.max("on") + 1).alias("level"),
        F.coalesce(F.max(F.when(~enough, F.col("upto"))), F.lit(0)).alias("base"),
    ).withColumnRenamed("from", "of")
    dealt = left.join(chosen, F.col("from").eqNullSafe(F.col("of"))).where("on = level")
    cells = dealt.groupBy("from", "in_block", "at", "short", "base").agg(F.sum("size").alias("level_words"))
    before = F.sum("level_words").over(Window.partitionBy("from").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    carry = F.col("short") - F.col("base") - F.coalesce(before, F.lit(0))
    cells = cells.select(F.col("from").alias("c_from"), F.col("in_block").alias("c_block"), "level_words", carry.alias("carry"))
    key = F.col("from").eqNullSafe(F.col("c_from")) & (F.col("in_block") == F.col("c_block"))
    known = open_blocks.join(chosen, F.col("from").eqNullSafe(F.col("of")), "left").drop("of").join(cells, key, "left").drop("c_from", "c_block")
    last = F.max(F.when((F.col("level") > 0) | (F.col("carry") > 0), F.col("at"))).over(Window.partitionBy("from"))
    known = written(known.withColumn("visited", F.col("at") <= last), "known")

    still = F.max("short") - F.sum(F.when(F.col("more"), F.col("size")).otherwise(0))
    reached = _second_draw(_first_draw(sizes.join(known, same))).groupBy(F.col("from").alias("of")).agg(
        still.alias("still"), F.max("miss").alias("was")
    )
    nearer = F.abs("still") < F.abs("was")
    reached = reached.select("of", nearer.alias("nearer"), F.when(nearer, F.col("still")).otherwise(F.col("was")).alias("off_by"))
    known = written(known.join(reached, F.col("from").eqNullSafe(F.col("of"))).drop("of"), "reached")
    rows = _second_draw(_first_draw(sizes.join(known.where((F.col("needs") > 0) & (F.col("needs") < F.col("words"))), same)))
    rows = rows.withColumn("once", F.col("again") | F.when(F.col("nearer"), F.col("more")).otherwise(F.col("fills")))
    swaps = _exchange(rows).select(F.col("source").alias("x_from"), F.col("block").alias("x_block"), "leaves", "enters")
    key = F.col("from").eqNullSafe(F.col("x_from")) & (F.col("in_block") == F.col("x_block"))
    return known.withColumn("short", F.when(F.col("nearer"), F.col("short"))).join(swaps, key, "left").select(
        "from", "in_block", "short", "level", "carry", "level_words", F.col("nearer") & F.col("visited"), "leaves", "enters"
    ).toDF("from", "in_block", "short", "level", "carry", "level_words", "visited", "leaves", "enters")


def _exchange(rows: DataFrame) -> DataFrame:
    """The drawn row that `leaves` and the other that `enters` for it, by their digests, for each block this helps.

    Of all pairs in a block, the one whose difference in size comes closest to `off_by`: drawn rows are looked up among
    the others at their size plus `off_by`. A row may also leave for none, and `enters` is then null. Rows whose digest
    occurs twice in the block stay as they are.
    """
    alone = F.count("*").over(Window.partitionBy("source", "block", "digest")) == 1
    rows = rows.withColumn("alone", alone).where("alone")
    place = F.col("size") + F.when(F.col("once"), F.col("off_by")).otherwise(0)
    other = F.when(~F.col("once"), F.struct("size", "digest"))
    order = Window.partitionBy("source", "block").orderBy("place", "digest")
    none = F.struct(F.lit(0).cast("long").alias("size"), F.lit(None).cast("string").alias("digest"))
    rows = rows.withColumn("place", place).withColumn("other", other)
    below = F.last("other", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    above = F.first("other", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    pairs = rows.select("source", "block", "off_by", "place", "once", "digest", F.array(below, above, none).alias("others"))
    pairs = pairs.where("once").withColumn("other", F.explode("others")).where("other is not null")
    best = F.min(F.struct(F.abs(F.col("place") - F.col("other.size")).alias("off"), F.col("digest"), F.col("other.digest").alias("enters")))
    found = pairs.groupBy("source", "block").agg(best.alias("best"), F.max("off_by").alias("off_by"))
    return found.where("best.off < abs(off_by)").select("source", "block", F.col("best.digest").alias("leaves"), "best.enters")


def draws(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, shards: int = 16, seed: int = 23,
    id_column: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """One row per row of `docs`: `row` (all its columns), `size`, `source_size`, `target`, `taken` and `copies`.

    `size` is the number of words, `taken` the words the mix takes of the row, `copies` an array with `shard` and
    `shuffle_key` for each time it is taken, at most `MOST_REPEATS` times. A null text has size 0; a null source is a
    source of its own. Rows equal in every column are interchangeable. Where the draws leave the sum of `taken` over a source
    below its target, no row that the last pass has left fits in what is missing; where they leave it above, it is so
    by less than it would be below without the last row. An exchange of rows only brings it nearer. The same input always gives the same draws, in any order of partitions. An empty table gives an
    empty result.
    """
    digest = F.md5(F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text), F.lit(""))))
    sized = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        digest.alias("digest"),
    )
    slim = written(sized.select("source", "size", "digest"), "sizes")
    plan = written(targets(slim, weights), "targets").withColumn("blocks", F.ceil(F.col("rows") / ROWS_PER_BLOCK))
    plan = plan.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    plan = plan.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")).withColumnRenamed("source", "from")

    def in_blocks(rows: DataFrame) -> DataFrame:
        keyed = rows.join(plan.select("from", "blocks"), F.col("source").eqNullSafe(F.col("from"))).drop("from")
        return keyed.withColumn("block", _number(F.col("digest")) % F.col("blocks")).drop("blocks")

    keyed, keyed_sizes = in_blocks(sized), in_blocks(slim)

    # Blocks in permuted order, and how many words of each the last pass still needs.
    blocks = keyed_sizes.groupBy("source", "block").agg(F.sum("size").alias("words"))
    place = F.md5(F.concat(F.coalesce("source", F.lit("")), F.lit("|"), F.col("block").cast("string")))
    order = Window.partitionBy("source").orderBy(place, "block")
    before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ordered = blocks.select("source", "block", "words", (F.row_number().over(order) - 1).alias("at"), before.alias("before"))
    ordered = ordered.join(plan, F.col("source").eqNullSafe(F.col("from"))).drop("from", "rows")
    ordered = ordered.withColumn("needs", F.col("rest") - F.col("before"))
    ordered = written(ordered, "blocks")
    further = _further(keyed_sizes, ordered)
    key = F.col("source").eqNullSafe(F.col("from")) & (F.col("block") == F.col("in_block"))
    ordered = written(ordered.join(further, key, "left").drop("from", "in_block"), "further")
    visited = (F.col("needs") > 0) | F.coalesce(F.col("visited"), F.lit(False))

    # The tree: quotas per source, counted in block draws, cut into runs for the shards.
    quota = F.max(F.col("passes") * F.col("blocks")) + F.count(F.when(visited, 1))
    counted = ordered.groupBy("source").agg(quota.cast("long").alias("quota")).orderBy(F.col("source").asc_nulls_last()).collect()
    split = split_quotas([r["quota"] for r in counted], shards, seed) if counted else []
    runs = docs.sparkSession.createDataFrame(
        [(r["source"], np.cumsum(row).tolist()) for r, row in zip(counted, split, strict=True)],
        T.StructType([T.StructField("of", T.StringType()), T.StructField("ends", T.ArrayType(T.LongType()))]),
    )
    dealt = ordered.join(runs, F.col("source").eqNullSafe(F.col("of"))).drop("of", "before", "rest")
    dealt = dealt.withColumnRenamed("source", "from").withColumnRenamed("block", "in_block")

    same = F.col("source").eqNullSafe(F.col("from")) & (F.col("block") == F.col("in_block"))
    joined = _second_draw(_first_draw(keyed.join(dealt, same)))
    once = F.col("again") | F.when(F.col("short").isNull(), F.col("fills")).otherwise(F.col("more"))
    once = (once & ~F.col("digest").eqNullSafe(F.col("leaves"))) | F.col("digest").eqNullSafe(F.col("enters"))
    joined = joined.withColumn("times", (F.col("passes") + F.when(once, 1).otherwise(0)).cast("int"))

    def copy(k: Column) -> Column:
        drawn = k * F.col("blocks") + F.col("at")
        shard = F.size(F.filter("ends", lambda end: end <= drawn))
        return F.struct(shard.alias("shard"), F.xxhash64(F.lit(seed), "digest", k).alias("shuffle_key"))

    copies = F.when(F.col("times") > 0, F.transform(F.sequence(F.lit(0), F.col("times") - 1), copy))
    return joined.select(
        "row", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"),
        F.coalesce(copies, F.array().cast("array<struct<shard:int,shuffle_key:bigint>>")).alias("copies"),
    )


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, shards: int = 16, seed: int = 23) -> DataFrame:
    """The mix itself: the columns of `docs`, then `shard` and `shuffle_key`, one row per copy taken.

    Written by shard and sorted by the key, it is shuffled. Columns that have these names already are replaced.
    """
    kept = [name for name in docs.columns if name not in ("shard", "shuffle_key")]
    rows = draws(docs, weights, shards, seed).select("row", F.explode("copies").alias("copy"))
    return rows.select(*[F.col("row")[name].alias(name) for name in kept], "copy.shard", "copy.shuffle_key")


def op9_source_mix(spark, sf_dir: str) -> DataFrame:
    """All documents with what the mix of all sources takes of each."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return draws(docs).select(F.col("row")["doc_id"].alias("doc_id"), "size", "source_size", "target", "taken")


ORACLE = f"""
with sized as (
  select doc_id, source, md5(concat(coalesce(doc_id::varchar, ''), '|', coalesce(text, ''))) as digest,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size from documents),
per_source as (select source, count(*) as n, sum(size)::bigint as source_size from sized group by source),
ranked as (
  select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight,
         source_size * {MOST_REPEATS} as most from per_source),
ordered as (select *, row_number() over (order by most / weight::double, weight, source nulls last) as i from ranked),
leveled as (
  select *, ((sum(source_size) over ())::bigint
             - coalesce(sum(most) over (order by i rows between unbounded preceding and 1 preceding), 0)::bigint)::double
            / ((sum(weight) over ())::bigint
             - coalesce(sum(weight) over (order by i rows between unbounded preceding and 1 preceding), 0)::bigint) as level
  from ordered),
cut as (select min(i) as i from leveled where most / weight::double > level),
shared as (
  select l.*, case when l.i >= c.i then weight * (select level from leveled where i = c.i) else most::double end as target
  from leveled l, cut c),
plan as (
  select *, ceil(n / {ROWS_PER_BLOCK}.0)::bigint as blocks,
         case when source_size > 0 then floor(target / source_size)::bigint else 0 end as passes from shared),
keyed as (
  select s.*, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size as rest,
         ('0x' || substr(s.digest, 1, 8))::bigint % p.blocks as block
  from sized s join plan p on s.source is not distinct from p.source),
words as (select source, block, sum(size)::bigint as words from keyed group by source, block),
placed as (
  select source, block, words, row_number() over w as nth,
         coalesce(sum(words) over (w rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from words window w as (partition by source order by md5(concat(coalesce(source, ''), '|', block::varchar)), block)),
taking as (
  select k.*, k.rest - p.before as needs, p.words, p.nth,
         sum(k.size) over (partition by k.source, k.block order by k.digest rows between unbounded preceding and current row)
           ::bigint as upto
  from keyed k join placed p on k.source is not distinct from p.source and k.block = p.block),
drawn as (select *, needs > 0 and upto <= needs as again from taking),
short as (
  select *, needs - coalesce(max(case when again then upto end) over (partition by source, block), 0) as missing from drawn),
filled as (
  select *, row_number() over (partition by source, block order by again, abs(size - missing), digest) as place from short),
first_draw as (select *, place = 1 and not again and abs(size - missing) < missing as fills from filled),
ends as (
  select source, max(missing) as short, max(missing) - sum(case when fills then size else 0 end)::bigint as miss
  from first_draw where needs > 0 and needs < words group by source),
fitting as (
  select f.*, e.short, e.miss,
         e.short is not null and not again and needs < words and size > 0 and size <= e.short as fits,
         length(bin(size)) as size_level
  from first_draw f left join ends e on f.source is not distinct from e.source and e.miss <> 0),
per_level as (select source, short, size_level, sum(size)::bigint as n from fitting where fits group by all),
up as (select *, (sum(n) over (partition by source order by size_level))::bigint as upto from per_level),
chosen as (
  select source, coalesce(min(case when upto >= short then size_level end), max(size_level) + 1) as level,
         coalesce(max(case when upto < short then upto end), 0) as base from up group by source),
leveled_rows as (
  select f.*, c.base, coalesce(fits and size_level < c.level, false) as lower,
         coalesce(fits and size_level = c.level, false) as on_level
  from fitting f left join chosen c on f.source is not distinct from c.source),
cells as (
  select source, block, nth, short, base, sum(size)::bigint as level_words from leveled_rows where on_level group by all),
carried as (
  select source, block, level_words, short - base - coalesce(sum(level_words) over (
    partition by source order by nth rows between unbounded preceding and 1 preceding), 0)::bigint as carry from cells),
walking as (
  select r.*, c.carry, c.level_words, sum(case when on_level then size end) over (
    partition by r.source, r.block order by r.digest rows between unbounded preceding and current row)::bigint as upto_level
  from leveled_rows r left join carried c on r.source is not distinct from c.source and r.block = c.block),
walked as (select *, on_level and upto_level <= carry as walks from walking),
gaps as (
  select *, carry - coalesce(max(case when walks then upto_level end) over (partition by source, block), 0) as gap from walked),
closing as (
  select *, again or lower or coalesce(walks, false) as had, row_number() over (
    partition by source, block order by again or lower or coalesce(walks, false), abs(size - gap) nulls first, digest) as turn
  from gaps),
second_draw as (
  select *, lower or coalesce(walks, false)
         or coalesce(carry > 0 and carry < level_words and not had and turn = 1 and abs(size - gap) < gap, false) as more
  from closing),
reached as (
  select source, max(miss) as was, max(short) - sum(case when more then size else 0 end)::bigint as still
  from second_draw where short is not null and needs < words group by source),
twice_drawn as (
  select s.*, case when abs(still) < abs(was) then still else was end as off_by,
         again or (case when abs(still) < abs(was) then more else fills end) as once,
         count(*) over (partition by s.source, block, digest) = 1 as alone
  from second_draw s left join reached r on s.source is not distinct from r.source),
asked as (
  select *, size + case when once then off_by else 0 end as spot from twice_drawn
  where alone and needs > 0 and needs < words and off_by is not null),
offers as (
  select *, last_value(case when not once then {{'size': size, 'digest': digest}} end ignore nulls) over (
              partition by source, block order by spot, digest rows between unbounded preceding and current row) as below,
         first_value(case when not once then {{'size': size, 'digest': digest}} end ignore nulls) over (
              partition by source, block order by spot, digest rows between current row and unbounded following) as above
  from asked),
pairs as (
  select source, block, off_by, digest as leaves, below.digest as enters, abs(spot - below.size) as off from offers
  where once and below is not null
  union all
  select source, block, off_by, digest, above.digest, abs(spot - above.size) from offers where once and above is not null
  union all
  select source, block, off_by, digest, null, abs(spot) from offers where once),
swaps as (
  select * from (select *, row_number() over (partition by source, block order by off, leaves, enters nulls first) as i from pairs)
  where i = 1 and off < abs(off_by))
select doc_id, size, source_size, target, (size * (passes + case
         when (once and d.digest is distinct from x.leaves) or coalesce(d.digest = x.enters, false) then 1 else 0 end))::bigint as taken
from twice_drawn d left join swaps x on d.source is not distinct from x.source and d.block = x.block
"""
