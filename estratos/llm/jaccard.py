"""Operator 10: n-gram Jaccard join by T-occurrence search with DivideSkip.

Documents with the same set of shingles form a class; only classes are compared, so copies never meet as pairs.

Bringing candidates together, in two steps that lose no link. First, a prefix: of a set of n shingles in hash order
the first n - s * n + k hold at least k that a similar set has in its own prefix too, so a set stays a candidate only
if k shingles of its prefix occur in other sets. That drops sets which merely share a passage with others. Second,
parts: two sets of sizes m and n with similarity s or more differ in at most (1 - s) / (1 + s) * (m + n) shingles, and
their sizes lie in the same or in adjacent bands of ratio 1 / s. For each pair of adjacent bands the shingles are
dealt by hash into more parts than there can be differences, so two similar sets have a part with equal content. Parts
that the same sets have are one, and its sets are compared by their prints: bit maps of the parity of shingle hashes,
which differ in at most as many bits as the sets do in shingles. Sets that share a part and whose prints are as near as
those of similar sets have to be are tied, and the components of these ties are the neighbourhoods within which links
can exist. Parts alone would tie sets that share a few common shingles, and with enough sets most would be one
neighbourhood.

Search. Within a neighbourhood each set is a query against an inverted index of the others. A similar set must occur
in T of the query's lists. DivideSkip puts the longest lists aside, merges the short ones, keeps those sets that occur
often enough to still reach T, and looks these up in the long lists by binary search.

A neighbourhood is searched by pairs of adjacent bands; one that is too large for one task is cut into blocks, and each
pair of blocks is searched on its own. Search results are the links of a spanning forest, which is all that components need; they never hold all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estratos.llm.arrow_text import LOWER, chunks, mix, range_hashes, signed, window_hashes, windows, word_hashes, words
from estratos.llm.common import read, row_hash, written
from estratos.llm.components import connected_components

BLOCK_SETS = 1024
BLOCK_SHINGLES = 1 << 20
PIECE_ROWS = 1024
#: Sets that share a part are compared in blocks of this size; groups of `FEW` and less by all pairs at once.
TIE_SETS = 1 << 14
FEW = 8
PAIRS = 4096
LEAST_BITS = 256
BITS_PER_KEY = 16
MOST_BITS = 1 << 26
#: Weight of a lookup against a merge step when lists are divided into long and short ones.
MU = 1.0


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of each text, A-Z lower-cased.

    A text of fewer words than a shingle has one shingle, all its words; a text without words has none.
    """
    for chunk in chunks(column):
        chunk = chunk._replace(data=LOWER[chunk.data])
        found = words(chunk)
        hashes = word_hashes(chunk, found)
        starts, own = windows(found.offsets, size)
        grams = window_hashes(hashes, starts, size)
        for i in range(len(chunk.bounds) - 1):
            first, last = found.offsets[i], found.offsets[i + 1]
            if own[i + 1] > own[i]:
                yield chunk.first + i, np.unique(grams[own[i] : own[i + 1]])
            elif last > first:
                yield chunk.first + i, range_hashes(hashes, np.array([first]), np.array([last]))
            else:
                yield chunk.first + i, np.zeros(0, dtype=np.uint64)


def set_hash(shingles: np.ndarray) -> int:
    """The class of a set: a 64-bit hash of its content. Two of a million different sets collide with 3e-8."""
    total = np.array([np.add.reduce(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)))], dtype=np.uint64)
    return int(signed(mix(total + np.uint64(len(shingles))))[0])


class Parts:
    """Size bands and the number of parts for each pair of adjacent bands, for a similarity in per cent."""

    def __init__(self, percent: int):
        self.percent = percent
        self.step = math.log(100 / (percent - 0.5))  # a little wide, so that rounding cannot part two adjacent bands
        self._count: dict[int, tuple[int, int]] = {}

    def band(self, size: int) -> int:
        return int(math.log(size) / self.step)

    def differences(self, m: int, n: int) -> int:
        """The most elements in which sets of these sizes can differ and still be similar."""
        return (100 - self.percent) * (m + n) // (100 + self.percent)

    def count(self, group: int) -> tuple[int, int]:
        """Largest size in bands group - 1 and group, and the number of parts: some more than can differ, since a
        part that is empty on both sides is equal but says nothing."""
        if group not in self._count:
            low, high = math.exp(self.step * (group - 1)), math.ceil(math.exp(self.step * (group + 1)))
            need = self.differences(high, high) + 1
            empty = need * math.exp(-low / need)
            self._count[group] = high, need + (math.ceil(empty + 4 * math.sqrt(empty)) + 1 if need > 1 else 0)
        return self._count[group]

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """One key for each part that is not empty, for both pairs of bands the set belongs to.

        A set with so few filled parts that the guarantee does not hold gets one more key, which all such sets share.
        """
        if not len(shingles):
            return np.zeros(0, dtype=np.uint64)
        out, own = [], self.band(len(shingles))
        content = mix(shingles ^ np.uint64(0x2545F4914F6CDD1D))
        for group in (own, own + 1):
            high, count = self.count(group)
            if count == 1:
                continue  # sets that small are similar only if they are equal
            part = (mix(shingles + np.uint64(group)) % np.uint64(count)).astype(np.int64)
            sums = np.zeros(count, dtype=np.uint64)
            np.add.at(sums, part, content)
            filled = np.unique(part)
            place = np.uint64(group << 40)
            out.append(mix(sums[filled] ^ mix(filled.astype(np.uint64) + place)))
            if len(filled) <= self.differences(len(shingles), high):
                out.append(mix(np.array([place + np.uint64(1 << 39)])))
        return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


    def prefix(self, shingles: np.ndarray) -> tuple[np.ndarray, int]:
        """The prefix of a sorted set, and how many of its shingles have to occur in other sets' prefixes.

        A set of n shingles has at least `shared` in common with a similar one, so its first n - shared + k hold the
        first k of those. The k of a smaller set is smaller; `shared` is also the least size a similar set can have, so
        the k of that size is what any similar set has to show.
        """
        n = len(shingles)
        shared = -(-self.percent * n // 100)
        return shingles[: n - shared + self._margin(n)], self._margin(shared)

    def _margin(self, n: int) -> int:
        return max(1, n * (100 - self.percent) // 200)


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return int(i)

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def divide_skip(
    sets: list[np.ndarray], side: np.ndarray, percent: int, lower: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links of a spanning forest over `sets`.

    Where `side` has both values, only links between the sides count. Links between two sets that are both `lower` are
    left to another call.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    sets, across = [sets[i] for i in order], len(set(side.tolist())) > 1
    side, sizes = side[order], np.array([len(s) for s in sets])
    lower = np.zeros(len(sets), dtype=bool) if lower is None else lower[order]
    tokens, token = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    by_token = np.argsort(token, kind="stable")
    postings = owner[by_token]  # the list of a token holds positions in ascending order
    begin = np.searchsorted(token[by_token], np.arange(len(tokens) + 1))
    first = np.concatenate(([0], np.cumsum(sizes)))
    frequent = np.add.reduceat((np.diff(begin)[token] > 1).astype(np.int64), first[:-1])
    forest, links = Forest(len(sets)), []
    for x in np.flatnonzero((100 * frequent >= percent * sizes) & ~lower).tolist():
        own = token[first[x] : first[x + 1]]
        low = int(np.searchsorted(sizes, -(-percent * sizes[x] // 100)))
        if low >= x:
            continue
        lists = [postings[begin[t] : begin[t + 1]] for t in own if begin[t + 1] - begin[t] > 1]
        least = -(-percent * (sizes[x] + sizes[low]) // (100 + percent))
        if len(lists) < least:
            continue
        lists.sort(key=len)
        longest = len(lists[-1])
        aside = min(least - 1, int(least / (MU * math.log2(longest + 1) + 1)), len(lists) - 1)
        merged = np.concatenate(lists[: len(lists) - aside])
        merged = merged[(merged >= low) & (merged < x)]
        counts = np.bincount(merged - low, minlength=x - low)
        needed = -(-percent * (sizes[low:x] + sizes[x]) // (100 + percent))
        found = np.flatnonzero(counts >= np.maximum(needed - aside, 1))
        if across:
            found = found[side[found + low] != side[x]]
        for k, long in enumerate(lists[len(lists) - aside :]):
            if not len(found):
                break
            at = np.searchsorted(long, found + low)
            at[at == len(long)] = 0
            counts[found] += long[at] == found + low
            found = found[counts[found] + aside - k - 1 >= needed[found]]
        for y in found[counts[found] >= needed[found]]:
            if forest.join(x, int(y) + low):
                links.append((int(order[x]), int(order[y + low])))
    return links


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in parts of so few rows that the sets of one part are little memory."""
    for batch in batches:
        for at in range(0, len(batch), PIECE_ROWS):
            yield batch.slice(at, PIECE_ROWS)


def classes(docs: DataFrame, size: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, `n_shingles`, `class` and `row_key` of each row; the class of a text without words is null."""

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [(len(s), set_hash(s) if len(s) else None) for _, s in shingle_sets(batch.column(1), size)]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([c for _, c in found], pa.int64()),
                    batch.column(2),
                ],
                names=["doc_id", "n_shingles", "class", "row_key"],
            )

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    chosen = chosen.withColumn("row_key", _row_key())
    return chosen.mapInArrow(of_batch, "doc_id bigint, n_shingles bigint, class bigint, row_key bigint")


def _row_key() -> Column:
    """A hash of id and text. By the id alone, rows that share one, or have none, would each stand for the classes of all."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text")


def candidates(docs: DataFrame, of_class: DataFrame, size: int, percent: int, text: str = "text") -> DataFrame:
    """`class` of the sets whose prefix occurs in other sets as often as that of a similar one has to.

    Only the shingles that no other class has in its prefix are counted, and what is left of a prefix is shared: the
    smallest and the largest class of a shingle tell, and both have a partial step, so that a shingle which a third
    of all documents have leaves each map task as one row.
    """
    parts = Parts(percent)

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            tokens, owners = [], []
            for _, shingles in shingle_sets(batch.column(0), size):
                if len(shingles):
                    own, _ = parts.prefix(shingles)
                    tokens.append(own)
                    owners.append(np.full(len(own), set_hash(shingles), dtype=np.int64))
            if tokens:
                yield pa.record_batch(
                    [pa.array(signed(np.concatenate(tokens))), pa.array(np.concatenate(owners))], names=["token", "class"]
                )

    prefixes = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(of_batch, "token bigint, class bigint")
    lists = prefixes.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    alone = lists.where("low = high").groupBy(F.col("low").alias("owner")).agg(F.count("*").alias("alone"))

    def margin(n: Column) -> Column:
        return F.greatest(F.lit(1), F.floor(n * (100 - percent) / 200)).cast("long")

    n = F.col("n_shingles")
    shared = F.ceil(n * percent / 100).cast("long")
    sized = of_class.where("class is not null").groupBy("class").agg(F.max("n_shingles").alias("n_shingles"))
    sized = sized.select("class", F.least(n, n - shared + margin(n)).alias("prefix"), margin(shared).alias("wanted"))
    counted = sized.join(alone, F.col("class") == F.col("owner"), "left")
    return counted.where(F.col("prefix") - F.coalesce("alone", F.lit(0)) >= F.col("wanted")).select("class")


def membership(keys: DataFrame) -> np.ndarray:
    """A bit map of the 64-bit hashes `row_key`: `BITS_PER_KEY` bits for each, `MOST_BITS` (8 MB) in all at most.

    It says of some keys that are not there that they are; the fuller it is, the more. It is built in Spark, and what
    passes the driver has a fixed bound.
    """
    bits = 1 << max(6, min(MOST_BITS, BITS_PER_KEY * max(1, keys.count())).bit_length())
    bits = min(bits, MOST_BITS)
    at = keys.select(F.col("row_key").bitwiseAND(F.lit(bits - 1)).alias("at"))
    words = at.groupBy(F.expr("cast(at >> 6 as int)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("set"))
    out = np.zeros(bits >> 6, dtype=np.int64)
    for batch in words.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out.view(np.uint64)


def candidate_sets(docs: DataFrame, of_class: DataFrame, size: int, percent: int) -> DataFrame:
    """`class`, `n` and `shingles` of each candidate, from one document of its class.

    Texts are not exchanged for that: each task makes the sets of those of its rows that the bit map lets through. Some
    sets that are no candidates come along, and a class may come from several tasks; neither adds a link.
    """
    first = of_class.where("class is not null").groupBy("class").agg(F.min("row_key").alias("row_key"))
    wanted = written(candidates(docs, of_class, size, percent).join(first, "class").select("row_key"), "wanted")
    map_of_bits = membership(wanted)
    mask = np.uint64(64 * len(map_of_bits) - 1)

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in pieces(batches):
            at = batch.column(0).to_numpy().view(np.uint64) & mask
            hit = (map_of_bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)
            found = []
            for _, s in shingle_sets(batch.column(1).filter(pa.array(hit == 1)), size):
                if len(s) and (own := set_hash(s)) not in seen:
                    seen.add(own)
                    found.append((own, s))
            if found:
                offsets = np.concatenate(([0], np.cumsum([len(s) for _, s in found]))).astype(np.int32)
                shingles = pa.array(signed(np.concatenate([s for _, s in found])))
                yield pa.record_batch(
                    [
                        pa.array([c for c, _ in found], pa.int64()), pa.array(np.diff(offsets).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), shingles),
                    ],
                    names=["class", "n", "shingles"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.select(_row_key().alias("row_key"), "text")
    return texts.mapInArrow(sets_of, "class bigint, n bigint, shingles array<bigint>")


def parity_print(shingles: np.ndarray) -> np.ndarray:
    """Words of a bit map that tells for each hash value whether an odd number of shingles has it.

    It has a power of two of bits, as many as shingles or more and `LEAST_BITS` at least. Equal shingles cancel out in the exclusive or of two
    prints, so these differ in no more bits than the sets do in shingles. The larger one folds to the size of the other.
    """
    bits = max(LEAST_BITS, 1 << (len(shingles) - 1).bit_length())
    at = (mix(shingles ^ np.uint64(0x6A09E667F3BCC909)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").view("<u8")


class Prints:
    """Classes with their sizes and prints; word i of a print is values[first + i]."""

    def __init__(self, table: pa.Table, percent: int):
        self.classes, self.sizes = table.column("class").to_numpy(), table.column("n").to_numpy()
        prints = table.column("print").combine_chunks()
        self.width = np.asarray(prints.value_lengths()).astype(np.int64)
        self.values = prints.flatten().to_numpy().view(np.uint64)
        self.first = np.cumsum(self.width) - self.width
        self.percent = percent

    def folded(self, rows: np.ndarray, want: int) -> np.ndarray:
        """The prints of some rows with `want` words each."""
        out = np.empty((len(rows), want), dtype=np.uint64)
        for have in np.unique(self.width[rows]).tolist():
            own = np.flatnonzero(self.width[rows] == have)
            words = self.values[self.first[rows[own]][:, None] + np.arange(have)]
            out[own] = np.bitwise_xor.reduce(words.reshape(len(own), have // want, want), axis=1)
        return out

    def may_link(self, a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the sets of rows `a` and `b`, with prints `x` and `y`, can be similar."""
        m, n = self.sizes[a], self.sizes[b]
        most = (100 - self.percent) * (m + n) // (100 + self.percent)
        return np.maximum(np.bitwise_count(x ^ y).sum(axis=1), np.abs(m - n)) <= most

    def pairs(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Those of the pairs of rows that can be similar."""
        narrow = np.minimum(self.width[a], self.width[b])
        for want in np.unique(narrow).tolist():
            own = np.flatnonzero(narrow == want)
            for at in range(0, len(own), PAIRS):
                i, j = a[own[at : at + PAIRS]], b[own[at : at + PAIRS]]
                near = self.may_link(i, j, self.folded(i, want), self.folded(j, want))
                yield i[near], j[near]

    def forest(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows that can be similar, with the components of all such pairs."""
        prints = self.folded(rows, int(self.width[rows].min()))
        label = np.arange(len(rows))
        for x in range(len(rows) - 1):
            others = np.flatnonzero(label[x + 1 :] != label[x]) + x + 1
            if not len(others):
                if (label == label[x]).all():
                    break
                continue
            near = others[self.may_link(rows[others], rows[[x]], prints[others], prints[[x]])]
            joined, at = np.unique(label[near], return_index=True)
            if len(joined):
                yield np.full(len(at), rows[x]), rows[near[at]]
                label[np.isin(label, joined)] = label[x]


def whole_groups(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows in which each group of successive rows that agree in `by` is whole, and the bounds of the groups."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        ids = rest.column(by).to_numpy()
        bounds = np.concatenate(([0], np.flatnonzero(ids[1:] != ids[:-1]) + 1))
        if bounds[-1]:
            yield rest.slice(0, bounds[-1]).combine_chunks(), bounds
            rest = rest.slice(bounds[-1])
    if rest is not None and len(rest):
        ids = rest.column(by).to_numpy()
        yield rest.combine_chunks(), np.concatenate(([0], np.flatnonzero(ids[1:] != ids[:-1]) + 1, [len(rest)]))


def neighbourhoods(sets: DataFrame, percent: int) -> DataFrame:
    """`node` (a class) and `component`, its neighbourhood, for the sets tied to another one.

    Two similar sets share a part, and so are compared. Of parts that the same sets have one is kept, told by the
    smallest and largest class and two sums of class bits. A part that very many sets have is compared by pairs of
    blocks of its sets.
    """
    parts = Parts(percent)

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [parts.keys(s.values.to_numpy().view(np.uint64)) for s in batch.column(1)]
            owners = np.repeat(batch.column(0).to_numpy(), [len(k) for k in found])
            keys = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
            yield pa.record_batch([pa.array(signed(keys), pa.int64()), pa.array(owners, pa.int64())], names=["key", "class"])

    keyed = written(sets.select("class", "shingles").mapInArrow(of_batch, "key bigint, class bigint"), "part-keys")
    # Pre-aggregated, and written, so that the join is one of two exchanges of their own and a frequent key can be split.
    # The sums are of parts of the class, whose bytes the exchange packs away next to those of the smallest and largest.
    low, high = F.shiftright("class", 24), F.col("class").bitwiseAND(F.lit((1 << 40) - 1))
    same = F.min("class").alias("least"), F.max("class").alias("most"), F.count("*").alias("sets"), F.sum(low).alias("s"), F.sum(high).alias("t")
    shared = keyed.groupBy("key").agg(*same).where("least < most")
    kept = shared.groupBy("least", "most", "sets", "s", "t").agg(F.min("key").alias("key"))
    kept = written(kept.select("key", F.ceil(F.col("sets") / TIE_SETS).cast("int").alias("blocks")), "ties")

    def print_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [parity_print(s.values.to_numpy().view(np.uint64)) for s in batch.column(1)]
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in found]))).astype(np.int32)
            words = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
            yield pa.record_batch(
                [
                    batch.column(0), pa.array([len(s) for s in batch.column(1)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(words), pa.int64())),
                ],
                names=["class", "n", "print"],
            )

    prints = sets.select("class", "shingles").mapInArrow(print_of, "class bigint, n bigint, print array<bigint>")
    prints = written(prints.dropDuplicates(["class"]), "prints")

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, "at"):
            rows, counts = Prints(table, percent), np.diff(bounds)
            found = []
            for count in range(2, FEW + 1):
                begins = bounds[:-1][counts == count]
                i, j = np.triu_indices(count, 1)
                found.extend(rows.pairs((begins[:, None] + i).ravel(), (begins[:, None] + j).ravel()))
            for k in np.flatnonzero(counts > FEW).tolist():
                found.extend(rows.forest(np.arange(bounds[k], bounds[k + 1])))
            if found:
                a, b = (np.concatenate([pair[side] for pair in found]) for side in (0, 1))
                yield pa.record_batch([pa.array(rows.classes[a]), pa.array(rows.classes[b])], names=["a", "b"])

    met = keyed.join(kept, "key").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    alone = F.col("blocks") == 1
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where(alone | (F.col("block") != F.col("other")))
    met = met.select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("at"), "class").join(prints, "class")
    tasks = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ties = met.repartition(tasks, "at").sortWithinPartitions("at").mapInArrow(tie, "a bigint, b bigint")
    return connected_components(ties)


def links(docs: DataFrame, of_class: DataFrame, size: int, percent: int) -> DataFrame:
    """Verified links `a`, `b` between classes; with the classes as nodes they have the components of the full join."""
    sets = written(candidate_sets(docs, of_class, size, percent), "sets")
    near = neighbourhoods(sets, percent).select(F.col("node").alias("class"), F.col("component").alias("near"))
    # Where a set is searched is settled on rows without shingles, so that the sets move once to be copied and once to
    # be searched. A set is searched with those of its own band and of the bands next to it.
    sized = sets.groupBy("class").agg(F.first("n").alias("n"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(Parts(percent).step)).cast("int")
    placed = written(sized.join(near, "class").select("class", "near", "n", band.alias("band")), "placed")
    paired = placed.select(
        "class", "near", "n",
        F.inline(F.array(F.struct("band", F.lit(False).alias("lower")), F.struct((F.col("band") + 1).alias("band"), F.lit(True).alias("lower")))),
    )
    total = paired.groupBy("near", "band").agg(
        F.count("*").alias("sets"), F.count_if(~F.col("lower")).alias("upper"), F.sum("n").alias("size")
    )
    cut = total.where("sets > 1 and upper > 0").select(
        "near", "band",
        F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"),
    )
    # Written, so that the join is one of two exchanges of their own and a large neighbourhood can be split.
    cut = written(cut, "cut")
    dealt = paired.join(cut, ["near", "band"]).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    met = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "near", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).alias("side"), "lower", "class",
    )
    # Few sets are tied to others. A bit map holds the rest back where they are read; the join does the rest.
    map_of_bits = membership(placed.select(F.col("class").alias("row_key")))
    mask = np.uint64(64 * len(map_of_bits) - 1)

    def of_placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) & mask
            hit = (map_of_bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)
            yield batch.filter(pa.array(hit == 1))

    moved = sets.select("class", "shingles").mapInArrow(of_placed, "class bigint, shingles array<bigint>")
    met = met.join(moved, "class")

    def search(table: pa.Table) -> pa.Table:
        sets = [s.values.to_numpy().view(np.uint64) for s in table.column("shingles").combine_chunks()]
        nodes = table.column("class").to_pylist()
        side, lower = (table.column(name).to_numpy(zero_copy_only=False) for name in ("side", "lower"))
        found = divide_skip(sets, side, percent, lower)
        return pa.table({"a": pa.array([nodes[i] for i, _ in found], pa.int64()), "b": pa.array([nodes[j] for _, j in found], pa.int64())})

    # The work of a group has little to do with its bytes, so groups are dealt to a fixed number of tasks.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = "near", "band", "i", "j"
    return met.repartition(4 * tasks, *group).groupBy(*group).applyInArrow(search, "a bigint, b bigint")


def jaccard_components(
    docs: DataFrame, size: int = 3, percent: int = 90, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`doc_id`, `n_shingles`, `class` and `component_id` for each row of `docs`.

    Two rows link when their sets of `size`-word shingles have a Jaccard similarity of `percent` or more; `component_id`
    is the smallest id reachable by links. A text without words (or a null one) links with nothing and is its own
    component. Repeated rows and ids get one row each; null ids do not count as smallest unless a component has no
    other. An empty table gives an empty result.
    """
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    of_class = written(classes(docs, size), "classes")
    component = connected_components(links(docs, of_class, size, percent))
    joined = of_class.join(component, of_class["class"] == component["node"], "left").select(
        "doc_id", "n_shingles", "class", F.coalesce("component", "class").alias("label")
    )
    # Written, so that the join is one of two exchanges of their own and a large component can be split.
    lowest = written(joined.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("lowest")), "lowest")
    return joined.join(lowest, "label", "left").select(
        "doc_id", "n_shingles", "class",
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("lowest")).alias("component_id"),
    )


def deduplicate(
    docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of `docs`, all columns as they are, with one row left of each component.

    The row with the smallest id stays (null ids last, then the smallest hash of the row); of rows equal in every column
    one stays. Texts without words are in no group and all stay.
    """
    marked = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"),
        row_hash(docs, 41).alias("mark"),
    )
    found = written(jaccard_components(marked, size, percent, "mark", "text"), "components").where("n_shingles > 0")
    found = found.select(F.col("doc_id").alias("mark"), F.col("component_id").alias("component"))
    slim = marked.select("mark", F.coalesce(F.col("id").cast("long"), F.lit((1 << 63) - 1)).alias("id"))
    grouped = slim.join(found.distinct(), "mark")
    first = grouped.groupBy("component").agg(F.min("id").alias("first"))
    first = grouped.join(first, "component").where("id = first").groupBy("component").agg(F.min("mark").alias("stays"))
    dropped = grouped.join(first, "component").where("mark <> stays").select("mark").distinct()
    worded = F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    nth = F.row_number().over(Window.partitionBy("mark").orderBy("mark"))
    once = marked.select("row", "mark", worded.alias("worded")).withColumn("nth", nth).where("nth = 1 or not worded")
    return once.join(dropped, "mark", "left_anti").select("row.*")


def op10_jaccard_components(spark, sf_dir: str) -> DataFrame:
    """Components of all documents under 3-word shingles with a similarity of 0.9 or more."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs, 3, 90).select("doc_id", "n_shingles", "component_id")
