"""Operator 1: quality classifier on random-indexing word vectors.

Every token has a sparse random index vector, given by its hash. The vector of a token is the sum of the index vectors
of the tokens around it, over the whole corpus (random indexing); tokens share `BUCKETS` rows by hash, so the table of
vectors has a fixed size. A document is the pooled mean and spread of its tokens' vectors. A network of two layers
gives a logit, and a temperature fitted on rows kept apart turns it into a calibrated probability.

The vectors are summed over all documents, in integers, so the order of partitions does not matter. Only the network
is fitted on a bounded sample: at most `SAMPLE` labelled rows, those with the smallest hash of their id.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estratos.llm.arrow_text import Words, chunks, document_of, mix, range_hashes
from estratos.llm.common import held_out, read, unit

BUCKETS = 1 << 14
DIM = 32
NONZERO = 4
REACH = 2
SAMPLE = 20_000
HIDDEN = 32
EPOCHS = 60
WIDTH = 2 * DIM + 3

_KIND = np.full(256, 2, dtype=np.uint8)  # other signs
_KIND[:33] = 0
_KIND[127] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1  # letters and digits


def tokens(chunk) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each token, and token offsets by document; a token is a run of letters and digits or of signs."""
    kind = _KIND[chunk.data]
    change = np.ones(len(kind), dtype=bool)
    change[1:] = kind[1:] != kind[:-1]
    cuts = chunk.bounds[1:-1]
    change[cuts[cuts < len(kind)]] = True
    edge = np.flatnonzero(change)
    stop = np.append(edge[1:], len(kind))
    real = kind[edge] > 0
    found = Words(edge[real], stop[real], np.searchsorted(edge[real], chunk.bounds))
    hashes = range_hashes(chunk.data, found.start, found.end)
    return (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), found.offsets


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """For each bucket the `NONZERO` places and signs of its sparse random vector."""
    raw = mix(np.arange(BUCKETS * NONZERO, dtype=np.uint64) + np.uint64(1)).reshape(BUCKETS, NONZERO)
    return (raw % np.uint64(DIM)).astype(np.int64), np.where(raw >> np.uint64(63), 1.0, -1.0)


def _accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, sign = index_vectors()
    sums = np.zeros(BUCKETS * DIM)
    seen = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for chunk in chunks(batch.column(0)):
            bucket, offsets = tokens(chunk)
            doc = document_of(offsets)
            seen += np.bincount(bucket, minlength=BUCKETS)
            for step in range(1, REACH + 1):
                near = doc[step:] == doc[:-step]
                left, right = bucket[:-step][near], bucket[step:][near]
                for own, other in ((left, right), (right, left)):
                    for k in range(NONZERO):
                        flat = own * DIM + place[other, k]
                        sums += np.bincount(flat, weights=sign[other, k], minlength=BUCKETS * DIM)
    rows = np.flatnonzero(seen)
    vectors = sums.reshape(BUCKETS, DIM).astype(np.int64)[rows]
    yield pa.record_batch(
        [pa.array(rows, pa.int32()), pa.array(seen[rows], pa.int64())]
        + [pa.array(np.ascontiguousarray(vectors[:, d]), pa.int64()) for d in range(DIM)],
        names=["bucket", "n", *(f"v{d}" for d in range(DIM))],
    )


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The table of `BUCKETS` unit vectors, from all documents; buckets never seen are zero."""
    schema = "bucket int, n bigint, " + ", ".join(f"v{d} bigint" for d in range(DIM))
    partial = docs.select(F.col(text).alias("text")).mapInArrow(_accumulate, schema)
    table = partial.groupBy("bucket").agg(F.sum("n"), *[F.sum(f"v{d}") for d in range(DIM)]).toPandas().to_numpy()
    out = np.zeros((BUCKETS, DIM), dtype=np.float32)
    if len(table):
        table = table.astype(np.float64)
        vectors = table[:, 2:]
        vectors -= table[:, 1:2] * (vectors.sum(axis=0) / table[:, 1].sum())  # take off what all tokens have in common
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        out[table[:, 0].astype(np.int64)] = vectors
    return out


def pool(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """What is pooled for each text: mean and spread of the token vectors, how many tokens equal the one or two before,
    and the logarithm of the number of tokens. All are zero for a text without tokens."""
    out = np.zeros((len(column), WIDTH), dtype=np.float32)
    for chunk in chunks(column):
        bucket, offsets = tokens(chunk)
        full = np.flatnonzero(np.diff(offsets))
        if not len(full):
            continue
        values, count = vectors[bucket], np.diff(offsets)[full][:, None].astype(np.float32)
        mean = np.add.reduceat(values, offsets[full], axis=0) / count
        square = np.add.reduceat(values * values, offsets[full], axis=0) / count
        rows = chunk.first + full
        out[rows, :DIM] = mean
        out[rows, DIM : 2 * DIM] = np.sqrt(np.maximum(square - mean * mean, 0))
        doc = document_of(offsets)
        for back in (1, 2):
            alike = np.zeros(len(bucket), dtype=np.float32)
            alike[back:] = (bucket[back:] == bucket[:-back]) & (doc[back:] == doc[:-back])
            out[rows, -1 - back] = np.add.reduceat(alike, offsets[full]) / count[:, 0]
        out[rows, -1] = np.log1p(count[:, 0])
    return out


class Network(NamedTuple):
    """Two layers over standardised features; `temperature` divides the logit."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 5) -> Network:
    """Adam on the cross-entropy; a fifth of the rows is kept apart for the temperature.

    With no rows, or rows of one label only, the network answers the smoothed share of label 1.
    """
    width = x.shape[1]
    base = (y.sum() + 1) / (len(y) + 2)
    if len(set(y.tolist())) < 2 or len(y) < 10:
        zero = np.zeros((width, 1))
        return Network(np.zeros(width), np.ones(width), zero, np.zeros(1), np.zeros(1), float(np.log(base / (1 - base))), 1.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    apart, train = order[: len(y) // 5], order[len(y) // 5 :]
    centre, scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-6
    z = (x - centre) / scale
    params = [rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(train)
        for begin in range(0, len(shuffled), 128):
            rows = shuffled[begin : begin + 128]
            hidden = np.tanh(z[rows] @ params[0] + params[1])
            error = 1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -40, 40))) - y[rows]
            back = np.outer(error, params[2]) * (1 - hidden * hidden)
            grads = [z[rows].T @ back, back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
            step += 1
            for i, grad in enumerate(grads):
                grad = grad / len(rows) + (1e-4 * params[i] if params[i].ndim == 2 else 0)
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad * grad
                rate = 0.003 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                params[i] = params[i] - rate * first[i] / (np.sqrt(second[i]) + 1e-8)
    net = Network(centre, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    logit, wanted = net.logit(x[apart]), y[apart]
    options = np.geomspace(0.25, 8, 60)
    losses = [np.logaddexp(0, -np.where(wanted > 0, 1, -1) * logit / t).mean() for t in options]
    return net._replace(temperature=float(options[int(np.argmin(losses))]))


def labelled_features(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, sample: int = SAMPLE) -> DataFrame:
    """Pooled features and label of at most `sample` rows; `docs` has doc_id and text, `labels` has doc_id and quality.

    An id with several labels counts with the lowest; rows with a null id or label are left out.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rate = min(1.0, 1.2 * sample / max(1, known.count()))
    chosen = docs.where(unit(F.xxhash64(F.lit(3), "doc_id")) < rate).select("doc_id", "text")

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pool(batch.column(1), vectors)
            yield pa.record_batch(
                [batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], names=["doc_id", "features"]
            )

    features = chosen.mapInArrow(pooled, "doc_id bigint, features binary")
    return features.join(known, "doc_id").orderBy(F.xxhash64(F.lit(3), "doc_id"), "features").limit(sample)


def fit(docs: DataFrame, labels: DataFrame, corpus: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """Word vectors of the whole `corpus`, and the network fitted on the labelled rows of `docs`."""
    vectors = word_vectors(corpus)
    rows = labelled_features(docs, labels, vectors, sample).collect()
    x = np.array([np.frombuffer(r["features"], dtype=np.float32) for r in rows]).reshape(len(rows), WIDTH)
    return vectors, fit_network(x.astype(np.float64), np.array([float(r["quality"]) for r in rows]))


def score(docs: DataFrame, vectors: np.ndarray, network: Network, text: str = "text", name: str = "score") -> DataFrame:
    """The columns of `docs` and the probability of label 1; null and empty texts score like a text without tokens.

    A column that has the name of the score already is replaced.
    """
    kept = [c for c in docs.columns if c != name]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = network.probability(pool(batch.column(0), vectors).astype(np.float64))
            yield pa.record_batch([*batch.columns[1:], pa.array(value, pa.float64())], names=[*kept, name])

    chosen = docs.select(F.col(f"`{text}`").alias(f"{text} scored"), *[F.col(f"`{c}`") for c in kept])
    return chosen.mapInArrow(scored, docs.select(*[F.col(f"`{c}`") for c in kept]).schema.add(name, "double"))


def accepted(docs: DataFrame, vectors: np.ndarray, network: Network, least: float, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, whose score is `least` or more."""
    at = docs.columns.index(text)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = network.probability(pool(batch.column(at), vectors).astype(np.float64))
            yield batch.filter(pa.array(value >= least))

    return docs.mapInArrow(kept, docs.schema)


def op1_quality_network(spark, sf_dir: str) -> DataFrame:
    """The quality of every whole document; labels of fold 0 of 5 are never read."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    learnable = labels.where(~held_out("doc_id", 5, 0))
    vectors, network = fit(docs.select("doc_id", "text"), learnable, docs.select("text"))
    chosen = docs.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "text")
    return score(chosen, vectors, network).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
