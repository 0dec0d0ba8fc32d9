"""Lexical search and vector search against plain Python over all rows."""

import math
import random
import re
from collections import Counter

import corpora
import numpy as np
import pytest

from estratos.llm import lexical, vectors

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranking(rows, items, k=10):
    """Ranked scores by the formula, for each item (item_id, [(score, doc_id), ...])."""
    docs = [(d, Counter(terms(t))) for d, t in rows]
    total = sum(sum(c.values()) for _, c in docs)
    n_docs = sum(1 for _, c in docs if c)
    frequency = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for d, c in docs:
            n, score = sum(c.values()), 0
            for t in terms(text):
                if t in c:
                    m = 25 + 75 * n * n_docs // total
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((score, d))
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item_id, i + 1, d, s) for i, (s, d) in enumerate(scored[:k])]
    return out


def by_item(rows):
    return Counter(tuple(r) for r in rows)


def searched(spark, rows, items, k=10):
    index = lexical.build(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    return lexical.search(index, spark.createDataFrame(items, "item_id long, text string"), k).collect()


@pytest.mark.parametrize(("block", "documents", "words", "per_block"), [(4, 50, 1 << 22, 3), (128, 1 << 14, 2000, 256), (128, 1 << 14, 1 << 22, 1)])
def test_ranking_is_that_of_all_documents(spark, monkeypatch, block, documents, words, per_block):
    for name, value in (("BLOCK", block), ("SHARD_DOCUMENTS", documents), ("SHARD_WORDS", words), ("PIECE_DOCUMENTS", 25), ("ITEMS_PER_BLOCK", per_block)):
        monkeypatch.setattr(lexical, name, value)
    rng = random.Random(block + per_block)
    words_of = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]  # a few words make up most of the text
    rows = [(i, " ".join(rng.choices(words_of, k=rng.choice([1, 3, 30, 300])))) for i in rng.sample(range(10**6), 400)]
    items = [(i, " ".join(rng.choices(words_of, k=rng.choice([1, 5, 40])))) for i in range(12)]
    assert by_item(searched(spark, rows, items)) == by_item(ranking(rows, items))


def test_search_of_odd_texts(spark):
    """Null, empty and repeated texts, null and repeated ids, one very long text, ties, and items of the same kind."""
    rows = corpora.odd_rows()
    items = [(1, "one two"), (1, "one two"), (None, "shared WORDS w1 w2 w2 w3"), (2, None), (3, ""), (4, "#%&"), (5, "nowhere"), (6, "ünïcode 漢字 Naïve a line")]
    got = searched(spark, rows, items)
    assert by_item(got) == by_item(ranking(rows, items))
    assert len([r for r in got if r["item_id"] == 1]) == 2 * len([r for r in ranking(rows, items[:1])])


def test_search_of_nothing(spark, empty):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(lexical.build(empty), items).collect() == []
    docs = corpora.documents(spark, [(1, "a b"), (2, None)])
    assert lexical.search(lexical.build(docs), items.limit(0)).collect() == []
    assert lexical.search(lexical.build(corpora.clashing(docs)), items).count() == 1
    assert lexical.search(lexical.build(corpora.documents(spark, [(1, None), (2, "")])), items).collect() == []


def test_numbers_survive_their_bytes():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28, 2**31 - 1, 5], dtype=np.int64)
    assert lexical.decode(lexical.encode(values)[0]).tolist() == values.tolist()
    assert lexical.decode(lexical.encode(values[:0])[0]).tolist() == []


def test_blocks_are_left_compressed(monkeypatch):
    """A rare term settles the result, so of a frequent one only the blocks of its documents are opened."""
    import pyarrow as pa

    monkeypatch.setattr(lexical, "BLOCK", 16)
    rows = [f"common filler{i % 7}" for i in range(2000)]
    for i in range(0, 2000, 180):
        rows[i] += " rare"
    parts = list(lexical.terms_of(pa.array(rows)))
    batch = lexical.make_shard(0, pa.array(range(2000)), np.concatenate([d for _, d, _ in parts]), np.concatenate([h for _, _, h in parts]))
    shard = lexical.Shard(pa.Table.from_batches([batch]), 2000, 4012)
    opened = []
    real = shard.open_blocks
    monkeypatch.setattr(shard, "open_blocks", lambda number, chosen: opened.append(len(chosen)) or real(number, chosen))
    (_, _, asked), = lexical.terms_of(pa.array(["common rare"]))
    best, _ = shard.top(shard.find(asked.view(np.int64)), np.array([100, 5000]), 10)
    assert len(best) == 10 and sum(opened) <= 1 + 12 < 2000 / 16


def product(q, c):
    return sum(math.floor(1024 * a) * math.floor(1024 * b) for a, b in zip(q, c, strict=False))


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def nearest(rows, k=10):
    rows, out = [(i, v) for i, v in rows if usable(v)], []
    for n, (q_id, q) in enumerate(rows):
        if q_id is None or q_id % 100:
            continue
        scored = [(min(max(product(q, v), -(2**63)), 2**63 - 1), i) for m, (i, v) in enumerate(rows) if m != n]
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(q_id, r + 1, i, s) for r, (s, i) in enumerate(scored[:k])]
    return out


def near(spark, rows, **sizes):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    index = vectors.build(df, **sizes)
    return vectors.search(index, vectors.rows_as_queries(index, vectors.F.col("query_id") % 100 == 0)).collect()


@pytest.mark.parametrize(("shard", "leaf", "block"), [(16, 4, 2), (8192, 8, 512), (100, 1, 3)])
def test_nearest_are_those_of_all_vectors(spark, monkeypatch, shard, leaf, block):
    monkeypatch.setattr(vectors, "BLOCK_QUERIES", block)
    rng = np.random.default_rng(shard)
    centres = rng.normal(size=(5, 12))
    rows = [(i * 10, (centres[i % 5] + 0.2 * rng.normal(size=12)).tolist()) for i in range(300)]
    rows += [(i, [0.5] * 12) for i in range(1000, 1400, 7)]  # a hot value: every one ties with every other
    assert by_item(near(spark, rows, shard_vectors=shard, leaf_vectors=leaf)) == by_item(nearest(rows))


def test_odd_vectors(spark):
    """Nulls, non-finite and huge components, repeated rows and ids, null ids, empty vectors and vectors of several lengths."""
    inf, nan = math.inf, math.nan
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, [-1.0, 0.5]), (None, [3.0, 3.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]),
        (4, [inf, 1.0]), (200, [-inf]), (5, []), (300, []), (400, [1.0, 2.0, 3.0]), (6, [0.0001, -0.0001]), (7, [1.0]),
    ]
    assert by_item(near(spark, rows)) == by_item(nearest(rows))
    huge = [*rows, (500, [1e18, -3.0]), (8, [2e15, 2.0]), (9, [-1e17, 1.0])]
    assert by_item(near(spark, huge)) == by_item(nearest(huge))
    clashing = spark.createDataFrame([(100, [1.0], "x"), (1, [2.0], "y")], "vec_id long, embedding array<float>, shard string")
    index = vectors.build(clashing)
    assert [tuple(r) for r in vectors.search(index, vectors.rows_as_queries(index, vectors.F.col("query_id") == 100)).collect()] == [(100, 1, 1, 2 * 1024**2)]


def test_nearest_of_nothing(spark):
    assert near(spark, [(1, [1.0])]) == [] and near(spark, [(100, [1.0])]) == []
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    index = vectors.build(empty)
    assert vectors.search(index, vectors.rows_as_queries(index, vectors.F.lit(True))).collect() == []


def test_boxes_are_left_out():
    """The walk stops at the first box below the k-th score: far from all leaves are scored."""
    rng = np.random.default_rng(1)
    points = np.floor(1024 * np.concatenate([rng.normal(c, 0.05, size=(500, 3)) for c in (-3, -1, 1, 3)]))
    tree = vectors.Tree(points, 20)
    shard = {"first": np.array(tree.first), "last": np.array(tree.last), "child": np.array(tree.child), "low": np.concatenate(tree.low), "high": np.concatenate(tree.high)}
    ordered, seen = points[tree.order], []

    class Counting(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    hits = list(vectors.best_first(shard, ordered.view(Counting), np.arange(2000), ordered[:1] * 0 + 1000, np.array([-1]), np.array([-(2**63)]), 10))
    assert hits[0][2].min() == np.sort(ordered.sum(axis=1))[-10] * 1000 and sum(seen) < 1000
