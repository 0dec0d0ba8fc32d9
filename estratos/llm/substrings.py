"""Operator 8: removal of repeated passages, by a join on windows that takes the place of relative Lempel-Ziv parsing.

The reference is the whole corpus, indexed by its windows of `length` words in blocks, one per partition of the window
hashes. A document is factored against every block: all its windows that can occur elsewhere are looked up, and a
factor is a run of successive windows whose first places in one document with a smaller id advance together, so that it
occurs there as it stands. Each factor holds at least `length` words; it need not be the longest there is, since each
window goes to the smallest id that has it. A greedy parsing would need the whole reference in one place. Windows across the boundary of two factors are looked up like the others, so a
passage that continues in another reference document is found whole.

To look up few windows, each has an anchor: the least hash of the `GRAM`-word runs in it. Equal windows have equal
anchors, so only windows whose anchor occurs in two different texts are indexed and looked up. Equal texts are
settled first and take part once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estratos.llm.arrow_text import chunks, mix, range_hashes, signed, window_hashes, windows, word_hashes, words
from estratos.llm.common import read, written

GRAM = 10


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` successive values, by doubling."""
    out, reach = values, 1
    while reach < width:
        step = min(reach, width - reach)
        out = np.minimum(out[: len(out) - step], out[step:])
        reach += step
    return out


def _windows(chunk, length: int):
    """Words, window starts, offsets by document, word hashes, and the anchor of each window."""
    found = words(chunk)
    hashes = word_hashes(chunk, found)
    starts, own = windows(found.offsets, length)
    if not len(starts):
        return found, starts, own, hashes, np.zeros(0, dtype=np.uint64)
    grams = window_hashes(hashes, np.arange(len(hashes) - GRAM + 1), GRAM)
    return found, starts, own, hashes, sliding_least(grams, length - GRAM + 1)[starts]


def _profile(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, same, digests, anchors = [], [], [], []
        for chunk in chunks(batch.column(1)):
            found, _, own, hashes, anchor = _windows(chunk, length)
            same.append(range_hashes(hashes, found.offsets[:-1], found.offsets[1:]))
            counts.append(np.diff(found.offsets))
            for i in range(len(chunk.bounds) - 1):
                text = chunk.data[chunk.bounds[i] : chunk.bounds[i + 1]].tobytes()
                digests.append(hashlib.sha256(b" ".join(text.split())).hexdigest())
                anchors.append(signed(np.unique(anchor[own[i] : own[i + 1]])))
        yield pa.record_batch(
            [
                batch.column(0),
                pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                pa.array(signed(np.concatenate(same)) if same else [], pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(anchors, pa.list_(pa.int64())),
                batch.column(2),
            ],
            names=["doc_id", "n_words", "same", "digest", "anchors", "text_key"],
        )


def _emit(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared, ids = batch.column(1), batch.column(0).to_numpy()
        for chunk in chunks(batch.column(2)):
            _, starts, own, hashes, anchor = _windows(chunk, length)
            grams = signed(window_hashes(hashes, starts, length))
            check = (window_hashes(mix(hashes), starts, length) >> np.uint64(33)).astype(np.int32)
            hit, doc, place = [], [], []
            for i in range(len(chunk.bounds) - 1):
                wanted = shared[chunk.first + i].values.to_numpy()
                found = np.flatnonzero(np.isin(signed(anchor[own[i] : own[i + 1]]), wanted))
                # A window that a document repeats is one row with all its places.
                _, first, which = np.unique(grams[own[i] + found], return_index=True, return_inverse=True)
                hit.append(own[i] + found[first])
                doc.append(np.full(len(first), ids[chunk.first + i]))
                order = np.argsort(which, kind="stable")
                place += [part.astype(np.int32) for part in np.split(found[order], np.cumsum(np.bincount(which))[:-1])] if len(found) else []
            hit = np.concatenate(hit)
            yield pa.record_batch(
                [pa.array(grams[hit]), pa.array(check[hit]), pa.array(np.concatenate(doc)), pa.array(place, pa.list_(pa.int32()))],
                names=["window", "check", "doc", "starts"],
            )


def factors(starts: np.ndarray, references: np.ndarray, length: int, places: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """Factors (first word, number of words, reference document) from the windows found and their places there.

    Without places, windows advance in their reference as they do in the document.
    """
    places = starts if places is None else places
    order = np.argsort(starts, kind="stable")
    starts, references, places = starts[order], references[order], places[order]
    cut = np.flatnonzero((np.diff(starts) != 1) | (np.diff(references) != 0) | (np.diff(places) != 1)) + 1
    return [
        (int(run[0]), int(run[-1] - run[0]) + length, int(reference[0]))
        for run, reference in zip(np.split(starts, cut), np.split(references, cut), strict=True)
        if len(run)
    ]


def repeated_passages(docs: DataFrame, length: int = 50, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: `doc_id`, `n_words`, `n_removed`, `kept_sha256` and `factors` (start, n_words, reference).

    Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return. A word is
    removed if a window of `length` words that covers it also starts in a document with a smaller id. Rows with equal
    ids do not remove each other's words; a null id counts as larger than any other. Null, empty and short texts lose
    nothing; an empty table gives an empty result. `factors` is null where a text repeats an earlier one as a whole.
    """
    last = F.lit((1 << 63) - 1)
    docs = docs.select(
        F.coalesce(F.col(id_column).cast("long"), last).alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    profile = written(
        docs.mapInArrow(
            lambda batches: _profile(batches, length),
            "doc_id bigint, n_words bigint, same bigint, digest string, anchors array<bigint>, text_key bigint",
        ),
        "profile",
    )
    anchors = profile.select("same", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.min("same").alias("low"), F.max("same").alias("high"))
    shared = shared.where("low < high").select("anchor")
    first = written(
        profile.groupBy("same").agg(F.min("doc_id").alias("first"), F.min_by("text_key", "doc_id").alias("first_key")), "first"
    )
    wanted = anchors.join(shared, "anchor").groupBy("same").agg(F.collect_set("anchor").alias("anchors"))
    wanted = wanted.join(first, "same")
    candidates = written(
        _texts_of(docs, wanted)
        .select("doc_id", "same", "anchors", "text")
        .mapInArrow(_same_only, "doc_id bigint, anchors array<bigint>, same bigint, text string")
        .dropDuplicates(["same"]),
        "candidates",
    )
    found = candidates.select("doc_id", "anchors", "text").mapInArrow(
        lambda batches: _emit(batches, length), "window bigint, check int, doc bigint, starts array<int>"
    )
    least = found.groupBy("window", "check").agg(
        F.min("doc").alias("reference"), F.max("doc").alias("largest"), F.min_by(F.col("starts")[0], "doc").alias("place")
    )
    # Written, so that the join below is one of two exchanges of their own and a frequent window can be split.
    least = written(least.where("reference < largest").drop("largest"), "reference")
    hits = found.join(least, ["window", "check"]).where("reference < doc").select("doc", "reference", "place", F.explode("starts").alias("start"))
    hits = hits.groupBy("doc").agg(F.collect_set(F.struct("start", "reference", "place")).alias("hits"))
    cleaned = candidates.join(hits, candidates["doc_id"] == hits["doc"]).select("same", "hits", "text")
    cleaned = cleaned.mapInArrow(
        lambda batches: _remove(batches, length),
        "same bigint, n_removed bigint, kept_sha256 string, factors array<struct<start:int,n_words:int,reference:bigint>>",
    )
    known = first.drop("first_key").join(cleaned, "same", "left")
    repeats = F.col("doc_id") > F.col("first")
    whole = repeats & (F.col("n_words") >= length)
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return profile.drop("anchors", "text_key").join(known, "same").select(
        F.when(F.col("doc_id") != last, F.col("doc_id")).alias("doc_id"),
        "n_words",
        F.when(whole, F.col("n_words")).when(repeats, 0).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, empty).when(repeats, F.col("digest")).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        F.when(~whole, F.coalesce("factors", F.array())).alias("factors"),
    )


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The row of each wanted text. By id alone, all rows of a frequent id (or without one) would meet all its texts."""
    return docs.join(wanted, (docs["doc_id"] == wanted["first"]) & (docs["text_key"] == wanted["first_key"]))


def _same_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop texts that only share the id with the text that was looked for."""
    for batch in batches:
        kept, same = [], batch.column(1).to_numpy()
        for chunk in chunks(batch.column(3)):
            found = words(chunk)
            own = signed(range_hashes(word_hashes(chunk, found), found.offsets[:-1], found.offsets[1:]))
            kept.append(own == same[chunk.first : chunk.first + len(own)])
        batch = batch.filter(pa.array(np.concatenate(kept) if kept else [], pa.bool_()))
        yield pa.record_batch([batch.column(i) for i in (0, 2, 1, 3)], names=["doc_id", "anchors", "same", "text"])


def _remove(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            hits = batch.column(1)[i].values
            start, reference, place = (hits.field(name).to_numpy().astype(np.int64) for name in ("start", "reference", "place"))
            spans = factors(start, reference, length, place)
            parts = batch.column(2)[i].as_py().encode().split()
            gone = np.zeros(len(parts), dtype=bool)
            for start, size, _ in spans:
                gone[start : start + size] = True
            kept = b" ".join(part for part, out in zip(parts, gone, strict=True) if not out)
            rows.append((int(gone.sum()), hashlib.sha256(kept).hexdigest(), spans))
        span = pa.struct([("start", pa.int32()), ("n_words", pa.int32()), ("reference", pa.int64())])
        yield pa.record_batch(
            [
                batch.column(0),
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.string()),
                pa.array([[dict(zip(("start", "n_words", "reference"), s, strict=True)) for s in r[2]] for r in rows], pa.list_(span)),
            ],
            names=["same", "n_removed", "kept_sha256", "factors"],
        )


def op8_repeated_passages(spark, sf_dir: str) -> DataFrame:
    """All documents without the words of 50-word windows that start in an earlier document."""
    return repeated_passages(read(spark, sf_dir, "documents")).drop("factors")
