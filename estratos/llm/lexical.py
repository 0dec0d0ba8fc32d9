"""Operator 11: ranked lexical search by Block-Max MaxScore over an inverted index in shards.

Index. A task cuts the documents it reads into shards. Within a shard documents are numbered in order of their length,
and a term's list is cut into blocks of `BLOCK` postings, each compressed (gaps and counts as variable-length integers)
and described by its first and last document and its largest count. As neighbours are of like length, the largest count
at the length of the first document bounds every score in the block closely, and it does so under any statistics of the
whole corpus, which therefore are not needed when a shard is made.

Search. Per shard and item the lists are ordered by their largest possible contribution. Those of the largest bounds are
read whole until the rest together cannot reach the k-th best score so far: these are the essential lists, and a
document in none of them is no result. For the others, a candidate is looked up by its number among the blocks; where
its score so far, the maximum of its block and the bounds of the lists still to come stay below the k-th score, it is
rejected and the block is not decompressed. The k best of each shard are merged.

Terms are kept as 64-bit hashes. A million terms of a query set against a billion different terms of a corpus hold two
different ones with the same hash with a probability of 5e-5.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estratos.llm.arrow_text import LOWER, chunks, document_of, signed, word_hashes, words
from estratos.llm.common import read, written
from estratos.llm.search_units import ShardNumbers, list_of, meetings, only, slices_of

BLOCK = 128
#: A shard is closed at so many documents or words. It holds one batch part more at most, or one very long document.
SHARD_DOCUMENTS = 1 << 14
SHARD_WORDS = 1 << 22
PIECE_DOCUMENTS = 1 << 10
ITEMS_PER_BLOCK = 256

#: True for the bytes that end a term: all ASCII characters but digits and letters.
ENDS = np.ones(256, dtype=bool)
ENDS[0x30:0x3A] = ENDS[0x41:0x5B] = ENDS[0x61:0x7B] = ENDS[0x80:] = False

INDEX = (
    "shard bigint, documents bigint, length bigint, ids array<bigint>, lengths array<int>, terms array<bigint>, "
    "frequencies array<int>, first array<int>, last array<int>, most array<int>, gap_bytes array<int>, "
    "count_bytes array<int>, gaps binary, counts binary"
)


def terms_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of a column of texts: the first row, the row of each term from there on, and the terms' hashes."""
    for chunk in chunks(column):
        chunk = chunk._replace(data=LOWER[chunk.data])
        found = words(chunk, ENDS)
        yield chunk.first, document_of(found.offsets), word_hashes(chunk, found)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative integers as variable-length bytes, seven bits each, and the number of bytes of each."""
    sizes = np.ones(len(values), dtype=np.int64)
    for k in range(1, 5):
        sizes += values >= (1 << 7 * k)
    out = np.zeros(int(sizes.sum()), dtype=np.uint8)
    starts = np.cumsum(sizes) - sizes
    for k in range(int(sizes.max(initial=0))):
        own = sizes > k
        out[starts[own] + k] = ((values[own] >> (7 * k)) & 127) | np.where(sizes[own] > k + 1, 128, 0)
    return out, sizes


def decode(data: np.ndarray) -> np.ndarray:
    """The integers of bytes made by `encode`."""
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    values = (data[starts] & 127).astype(np.int64)
    for k in range(1, int((ends - starts).max(initial=0)) + 1):
        own = ends - starts >= k
        values[own] |= (data[starts[own] + k] & 127).astype(np.int64) << (7 * k)
    return values


def make_shard(number: int, ids: pa.Array, document: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """One row of the index from the documents' ids and the document and hash of each of their words."""
    counted = np.bincount(document, minlength=len(ids))
    order = np.argsort(counted, kind="stable")
    lengths, place = counted[order], np.empty(len(ids), dtype=np.int64)
    place[order] = np.arange(len(ids))
    document = place[document]
    by_term = np.lexsort((document, hashes))
    term, document = hashes[by_term], document[by_term]
    starts = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (document[1:] != document[:-1])))) if len(term) else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate((starts, [len(term)])))
    term, document = term[starts], document[starts]  # one posting each from here on
    new = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else np.zeros(0, np.int64)
    frequency = np.diff(np.concatenate((new, [len(term)])))
    within = np.arange(len(term)) - np.repeat(new, frequency)
    heads = np.flatnonzero(within % BLOCK == 0)
    sizes = np.diff(np.concatenate((heads, [len(term)])))
    gap = np.zeros(len(term), dtype=np.int64)
    gap[1:] = document[1:] - document[:-1]
    in_block = np.ones(len(term), dtype=bool)
    in_block[heads] = False  # the first document of a block is in its description
    several = np.repeat(sizes > 1, sizes)  # the count of a block of one is its largest count
    most = np.maximum.reduceat(counts, heads) if len(heads) else counts

    def packed(values: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data, size = encode(values[kept])
        spread = np.zeros(len(values), dtype=np.int64)
        spread[kept] = size
        return data, np.add.reduceat(spread, heads) if len(heads) else spread

    gaps, gap_bytes = packed(gap, in_block)
    told, count_bytes = packed(counts, several)
    ends = heads + sizes - 1
    ints = [frequency, document[heads], document[ends], most, gap_bytes, count_bytes]
    columns = [
        pa.array([number], pa.int64()), pa.array([int((lengths > 0).sum())], pa.int64()), pa.array([int(lengths.sum())], pa.int64()),
        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order))),
        list_of(lengths.astype(np.int32), pa.int32()), list_of(signed(term[new]), pa.int64()),
        *[list_of(x.astype(np.int32), pa.int32()) for x in ints],
        pa.array([gaps.tobytes()], pa.binary()), pa.array([told.tobytes()], pa.binary()),
    ]
    return pa.record_batch(columns, names=[part.split()[0] for part in INDEX.split(", ")])


def build(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of all terms of all documents, a row per shard. Nothing is shuffled. A null text has no terms."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, ids, parts, rows, size = ShardNumbers(), [], [], 0, 0
        for batch in batches:
            for at in range(0, len(batch), PIECE_DOCUMENTS):
                piece = batch.slice(at, PIECE_DOCUMENTS)
                for first, document, hashes in terms_of(piece.column(1)):
                    parts.append((document + (rows + first), hashes))
                    size += len(hashes)
                ids.append(piece.column(0))
                rows += len(piece)
                if rows >= SHARD_DOCUMENTS or size >= SHARD_WORDS:
                    yield make_shard(numbers.next(), pa.concat_arrays(ids), *map(np.concatenate, zip(*parts, strict=True)))
                    ids, parts, rows, size = [], [], 0, 0
        if rows:
            yield make_shard(numbers.next(), pa.concat_arrays(ids), *map(np.concatenate, zip(*parts, strict=True)))

    chosen = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return written(chosen.mapInArrow(shards, INDEX), "inverted-index")


def item_terms(items: DataFrame, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """`item`, a number for each row, its `item_id`, and its distinct terms with `repeats`."""

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, row, hashes in terms_of(batch.column(2)):
                pairs = np.stack((row.astype(np.uint64), hashes), axis=1)
                distinct, repeats = np.unique(pairs, axis=0, return_counts=True)
                rows = pa.array(distinct[:, 0].astype(np.int64) + first)
                yield pa.record_batch(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(signed(distinct[:, 1].copy())), pa.array(repeats.astype(np.int64))],
                    names=["item", "item_id", "term", "repeats"],
                )

    numbered = items.select(
        F.monotonically_increasing_id().alias("item"), F.col(f"`{id_column}`").cast("long").alias("item_id"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    return written(numbered.mapInArrow(of_batch, "item bigint, item_id bigint, term bigint, repeats bigint"), "item-terms")


class Shard:
    """One row of the index, opened for searches."""

    def __init__(self, table: pa.Table, documents: int, length: int):
        arrays = {n: only(table, n) for n in ("lengths", "terms", "frequencies", "first", "last", "most", "gap_bytes", "count_bytes")}
        self.id_list = table.column("ids").combine_chunks().values
        self.ids = self.id_list.fill_null(2**63 - 1).to_numpy(zero_copy_only=False)
        self.terms = arrays["terms"]
        self.order = np.argsort(self.terms, kind="stable")  # hashes are stored as signed numbers
        self.sorted = self.terms[self.order]
        self.first, self.last, self.most = arrays["first"], arrays["last"], arrays["most"]
        blocks = -(-arrays["frequencies"].astype(np.int64) // BLOCK)
        self.begin = np.concatenate(([0], np.cumsum(blocks)))
        self.frequencies = arrays["frequencies"].astype(np.int64)
        self.gap_ends = np.concatenate(([0], np.cumsum(arrays["gap_bytes"], dtype=np.int64)))
        self.count_ends = np.concatenate(([0], np.cumsum(arrays["count_bytes"], dtype=np.int64)))
        self.gaps, self.counts = (np.frombuffer(table.column(n)[0].as_buffer(), dtype=np.uint8) for n in ("gaps", "counts"))
        # Lengths repeat, and products with the size of the corpus may exceed 64 bits on their way.
        distinct, which = np.unique(arrays["lengths"], return_inverse=True)
        norms = [25 + 75 * int(n) * documents // length for n in distinct] if length else [25] * len(distinct)
        self.eight_m = 8 * np.array(norms, dtype=np.int64)[which]
        self._whole: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def find(self, term: np.ndarray) -> np.ndarray:
        """The number of the list of each term, -1 where the shard has none."""
        if not len(self.sorted):
            return np.full(len(term), -1)
        at = np.minimum(np.searchsorted(self.sorted, term), len(self.sorted) - 1)
        return np.where(self.sorted[at] == term, self.order[at], -1)

    def impact(self, counts: np.ndarray, document: np.ndarray) -> np.ndarray:
        return (10**9 * counts) // (1000 * counts + self.eight_m[document])

    def block_bounds(self, number: int) -> np.ndarray:
        """What a document of each block of a list can contribute at most, before the weight."""
        own = slice(self.begin[number], self.begin[number + 1])
        return self.impact(self.most[own].astype(np.int64), self.first[own])

    def open_blocks(self, number: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of the chosen blocks of a list, which are decompressed."""
        block = self.begin[number] + chosen
        sizes = np.minimum(self.frequencies[number] - chosen * BLOCK, BLOCK)
        heads = np.cumsum(sizes) - sizes
        document = np.zeros(int(sizes.sum()), dtype=np.int64)
        rest = np.ones(len(document), dtype=bool)
        rest[heads] = False
        document[rest] = decode(_joined(self.gaps, self.gap_ends[block], self.gap_ends[block + 1]))
        document[heads] = self.first[block]
        total = np.cumsum(document)
        document = total - np.repeat(total[heads] - self.first[block], sizes)
        counts = np.repeat(self.most[block].astype(np.int64), sizes)
        counts[np.repeat(sizes > 1, sizes)] = decode(_joined(self.counts, self.count_ends[block], self.count_ends[block + 1]))
        return document, self.impact(counts, document)

    def whole(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """A whole list; kept, as the items of a block share many."""
        if number not in self._whole:
            self._whole[number] = self.open_blocks(number, np.arange(self.begin[number + 1] - self.begin[number]))
        return self._whole[number]

    def top(self, lists: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the best `k` with a score above 0, by score, then id."""
        blocks = [self.block_bounds(number) * w for number, w in zip(lists.tolist(), weights.tolist(), strict=True)]
        bounds = np.array([b.max() for b in blocks], dtype=np.int64)
        by_bound = np.argsort(bounds, kind="stable")
        up_to = np.cumsum(bounds[by_bound])  # what the lists up to here can add together
        score, least = np.zeros(len(self.ids), dtype=np.int64), 1
        j = len(by_bound) - 1
        while j >= 0 and up_to[j] >= least:
            document, impact = self.whole(int(lists[by_bound[j]]))
            score[document] += impact * weights[by_bound[j]]
            least = _kth(score, k, least)
            j -= 1
        found = np.flatnonzero(score > 0)
        found = found[score[found] + (up_to[j] if j >= 0 else 0) >= least]
        for i in range(j, -1, -1):
            if not len(found):
                break
            number, w, own = int(lists[by_bound[i]]), weights[by_bound[i]], blocks[by_bound[i]]
            lower = up_to[i - 1] if i else 0
            last = self.last[self.begin[number] : self.begin[number + 1]]
            at = np.searchsorted(last, found)
            inside = at < len(last)
            limit = np.where(inside, own[np.minimum(at, len(last) - 1)], 0)
            stays = score[found] + limit + lower >= least
            found, at, inside = found[stays], at[stays], inside[stays]
            if inside.any():
                document, impact = self.open_blocks(number, np.unique(at[inside]))
                hit = np.minimum(np.searchsorted(document, found), len(document) - 1)
                score[found] += np.where(document[hit] == found, impact[hit] * w, 0)
            least = _kth(score[found], k, least)
            found = found[score[found] + lower >= least]
        best = found[np.lexsort((self.ids[found], -score[found]))][:k]
        return best, score[best]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Pieces of a byte array end to end."""
    sizes = ends - starts
    return data[np.arange(int(sizes.sum())) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)]


def _kth(score: np.ndarray, k: int, least: int) -> int:
    """The k-th largest of the scores that are at least `least`, or `least` where there are fewer."""
    reached = score[score >= least]
    return least if len(reached) < k else max(least, int(np.partition(reached, len(reached) - k)[len(reached) - k]))


def _search(table: pa.Table, documents: int, length: int, k: int) -> pa.Table:
    shard = Shard(table, documents, length)
    packed = table.column("wanted").combine_chunks().values
    item, term, weight = (packed.field(n).to_numpy(zero_copy_only=False) for n in ("item", "term", "weight"))
    lists = shard.find(term)
    kept = np.flatnonzero((lists >= 0) & (weight > 0))
    kept = kept[np.argsort(item[kept], kind="stable")]
    item, lists, weight = item[kept], lists[kept], weight[kept]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(item)) + 1, [len(item)]))
    items, places, scores = [], [], []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b > a:
            best, score = shard.top(lists[a:b], weight[a:b], k)
            items.append(np.full(len(best), item[a]))
            places.append(best)
            scores.append(score)
    none = [np.zeros(0, dtype=np.int64)]
    return pa.table(
        {
            "item": pa.array(np.concatenate(items or none), pa.int64()),
            "doc_id": shard.id_list.take(pa.array(np.concatenate(places or none))),
            "score": pa.array(np.concatenate(scores or none), pa.int64()),
        }
    )


def search(index: DataFrame, items: DataFrame, k: int = 10, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """`item_id`, `rank` from 1, `doc_id` and `score` of the `k` best documents of each row of `items`.

    Only scores above 0 count. Equal scores go to the smaller id, null ids last. Repeated ids, of documents or items,
    are documents and items of their own. An item without terms, null or empty, has no results, and neither has any
    item where the index is empty.
    """
    totals = index.agg(F.sum("documents").alias("n"), F.sum("length").alias("l")).first()
    documents, length = int(totals["n"] or 0), int(totals["l"] or 0)
    asked = item_terms(items, id_column, text)
    held = index.select(F.explode(F.arrays_zip("terms", "frequencies")).alias("t")).select("t.*")
    held = held.join(asked.select(F.col("term").alias("terms")).distinct(), "terms")
    frequency = held.groupBy(F.col("terms").alias("term")).agg(F.sum(F.col("frequencies").cast("long")).alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0) * documents + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long")
    weighted = asked.join(frequency, "term").select("item", "term", (weight * F.col("repeats")).alias("weight"))
    count = max(1, math.ceil(asked.select("item").distinct().count() / ITEMS_PER_BLOCK))
    blocks = weighted.groupBy(F.pmod(F.xxhash64("item"), F.lit(count)).cast("int").alias("block")).agg(
        F.collect_list(F.struct("item", "term", "weight")).alias("wanted")
    )
    pairs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    found = meetings(pairs, written(blocks, "item-blocks"), slices_of(index)).applyInArrow(
        lambda table: _search(table, documents, length, k), "item bigint, doc_id bigint, score bigint"
    )
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = asked.groupBy("item").agg(F.first("item_id").alias("item_id"))
    return best.join(named, "item").select("item_id", "rank", "doc_id", "score")


def op11_block_max_search(spark, sf_dir: str) -> DataFrame:
    """The ten best of all documents for each item of the benchmark."""
    return search(build(read(spark, sf_dir, "documents")), read(spark, sf_dir, "benchmark"), 10)


ORACLE = """
with term_of_document as (
  select r, doc_id, unnest(w) as term from (
    select row_number() over () as r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from documents)),
total as (select count(distinct r) as n, count(*) as l from term_of_document),
document as (select r, count(*) as n from term_of_document group by r),
posting as (select r, any_value(doc_id) as doc_id, term, count(*) as tf from term_of_document group by r, term),
frequency as (select term, count(*) as df from posting group by term),
item as (
  select row_number() over () as i, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from benchmark),
asked as (select i, item_id, term, count(*) as repeats from (select i, item_id, unnest(w) as term from item) group by all),
scored as (
  select i, item_id, r, any_value(doc_id) as doc_id,
         sum(repeats * floor(1000 * ln((2.0::double * total.n + 2) / (2.0::double * df + 1)))::bigint
             * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * document.n * total.n) // total.l))))::bigint as score
  from asked join posting using (term) join frequency using (term) join document using (r) cross join total
  group by i, item_id, r)
select item_id, rank::int as rank, doc_id, score from (
  select *, row_number() over (partition by i order by score desc, doc_id) as rank from scored where score > 0)
where rank <= 10
"""
