"""Operator 3: benchmark decontamination by winnowing.

Texts become words; every run of `GRAM` words has a hash, and of each window of successive hashes the least is kept as
a fingerprint (winnowing). With windows of `span - GRAM + 1` hashes, any `span` words that two texts share have a
fingerprint in common. Documents and benchmark items are joined on fingerprints; each hit is then extended to all
windows of `span` words around it, which are compared with the items' windows as text. Items of fewer than `span`
words are looked for as a whole, with windows of their own length.

Only DataFrame functions are used. The first join carries hashes and ids, the second one the few windows with a hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estratos.llm.common import read, row_hash, written

SPAN = 10
GRAM = 5
#: Everything but ASCII letters and digits and bytes beyond ASCII parts words; A-Z are lower-cased before.
SEPARATOR = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(lowered, SEPARATOR, -1), lambda w: w != "")


def _joined(values: str, count: int, combine) -> Column:
    """For each place of an array from which `count` values follow, `combine` of them."""
    every = F.transform(values, lambda x, i: combine(x, *[F.get(F.col(values), i + k) for k in range(1, count)]))
    return F.slice(every, 1, F.greatest(F.size(values) - count + 1, F.lit(0)))


def _spelled(size: int):
    """The words of the window that begins at a place counted from 1."""
    return lambda i: F.concat_ws(" ", F.slice("words", i, size))


def _extended(size: int):
    """The window at a place counted from 0 if its fingerprint was matched, else null."""

    def window(least: Column, i: Column) -> Column:
        span = F.struct(i.alias("start"), (i + size).alias("end"), _spelled(size)(i + 1).alias("window"))
        return F.when(F.array_contains("matched", least), span)

    return window


def with_fingerprints(df: DataFrame, span: int) -> DataFrame:
    """Adds `least`: for each window of `span` words of `hashes` the fingerprint it selects."""
    gram = min(GRAM, span)
    grams = df.withColumn("grams", _joined("hashes", gram, lambda *h: F.xxhash64(F.lit(span), *h)))
    width = span - gram + 1
    least = F.col("grams") if width == 1 else _joined("grams", width, lambda *g: F.least(*g))
    return grams.withColumn("least", least).drop("grams")


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def item_windows(benchmark: DataFrame, span: int, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """`item_id`, `size`, `window` (its words joined by a blank) and `least`, one row per window of an item."""
    items = benchmark.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("item_id"), words_of(F.col(text)).alias("words")
    )
    items = items.where(F.size("words") > 0).withColumn("size", F.least(F.size("words"), F.lit(span)))
    return _hashed(items)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """For each row of `docs`: `doc_id`, `n_words`, `n_hit`, `items` (sorted ids) and `hits` (start, end in words).

    A window is `span` successive words of an item, or a whole item of fewer words. A word of a document is hit if it
    lies in an occurrence of a window. Null texts have no words; items without words or without id are left out; items
    with the same text are all reported. Rows with equal id and text get the same answer each. With an empty benchmark
    nothing is hit, and an empty table of documents gives an empty result.
    """
    prepared = written(item_windows(benchmark, span), "items")
    sizes = sorted(r["size"] for r in prepared.select("size").distinct().collect())  # at most `span` numbers
    keyed = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = keyed.withColumn("mark", F.xxhash64("text"))
    counted = keyed.select("doc_id", "mark", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    if not sizes:
        empty = F.array().cast("array<bigint>"), F.array().cast("array<struct<start:int,end:int>>")
        return counted.select(
            "doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), empty[0].alias("items"), empty[1].alias("hits")
        )

    windows, prints = [], []
    for size in sizes:
        own = with_fingerprints(prepared.where(F.col("size") == size), size)
        texts = F.transform(F.sequence(F.lit(1), F.size("least")), _spelled(size))
        windows.append(own.select("item_id", F.explode(F.arrays_zip("least", texts.alias("window"))).alias("w")))
    index = windows[0]
    for more in windows[1:]:
        index = index.unionAll(more)
    # Items that share a window share a row, so a common window meets each document once.
    index = written(
        index.groupBy(F.col("w")["window"].alias("window"), F.col("w")["least"].alias("least"))
        .agg(F.collect_set("item_id").alias("items")),
        "windows",
    )

    hashed = _hashed(keyed.select("doc_id", "mark", words_of(F.col("text")).alias("words")))
    for size in sizes:
        own = with_fingerprints(hashed, size)
        prints.append(own.select("doc_id", "mark", F.explode(F.array_distinct("least")).alias("least")))
    seen = prints[0]
    for more in prints[1:]:
        seen = seen.unionAll(more)
    # A semi-join of two exchanges of their own, so that a fingerprint very many documents have can be split.
    found = seen.join(index.select("least"), "least", "left_semi").groupBy("doc_id", "mark").agg(F.collect_set("least").alias("matched"))
    found = found.withColumnRenamed("doc_id", "id").withColumnRenamed("mark", "same")

    # Extension: the windows around each hit, as text.
    near = keyed.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("same")))
    near = _hashed(near.dropDuplicates(["doc_id", "mark"]).select("doc_id", "mark", "matched", words_of(F.col("text")).alias("words")))
    extended = []
    for size in sizes:
        own = with_fingerprints(near, size)
        hit = F.filter(F.transform("least", _extended(size)), lambda x: x.isNotNull())
        extended.append(own.select("doc_id", "mark", F.explode(hit).alias("hit")))
    spans = extended[0]
    for more in extended[1:]:
        spans = spans.unionAll(more)
    spans = spans.select("doc_id", "mark", "hit.*").join(index.select("window", "items"), "window")
    matched = spans.groupBy("doc_id", "mark").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("hits"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")),
        lambda acc, h: F.struct(
            (acc["n"] + F.greatest(h["end"] - F.greatest(h["start"], acc["upto"]), F.lit(0))).alias("n"),
            F.greatest(h["end"], acc["upto"]).alias("upto"),
        ),
        lambda acc: acc["n"],
    )
    matched = matched.select(
        F.col("doc_id").alias("id"), F.col("mark").alias("same"), covered.alias("n_hit"),
        F.sort_array("items").alias("items"), "hits",
    )
    out = counted.join(matched, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("same")), "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array()).alias("items"), F.coalesce("hits", F.array()).alias("hits"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, of which no word is hit."""
    marked = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        F.col(f"`{text}`").alias("text"), row_hash(docs, 43).alias("doc_id"),
    )
    hit = contaminated(marked, benchmark, span).where("n_hit > 0").select("doc_id").distinct()
    return marked.join(hit, "doc_id", "left_anti").select("row.*")


def op3_winnowing(spark, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items, with windows of 10 words."""
    found = contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    named = F.array_join(F.sort_array(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(named, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = """
with doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w, row_number() over () as r
  from documents),
item as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark where item_id is not null),
sized as (select item_id, w, least(len(w), 10) as n from item where len(w) > 0),
item_window as (
  select distinct item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as t
  from (select *, unnest(range(1, len(w) - n + 2)) as i from sized)),
doc_window as (
  select r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') as t
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i
        from doc, (select distinct n from sized) where len(w) >= n)),
hit as (select d.r, d.i, d.n, m.item_id from doc_window d join item_window m using (n, t)),
words as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hit) group by r),
items as (
  select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names
  from (select distinct r, item_id::varchar as item_id from hit) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join words using (r) left join items using (r)
"""
