"""Shard shuffle and source mix."""

import hashlib
import random
from collections import Counter

import corpora
import numpy as np
import pytest
from pyspark.sql import functions as F

from estratos.llm import mixing, sharding


def test_the_matrix_has_the_given_sums():
    blocks, shards = [5, 0, 17, 3, 90, 1], [39, 39, 38]
    matrix = np.array(sharding.communication_matrix(blocks, shards, 3))
    assert matrix.sum(axis=1).tolist() == blocks and matrix.sum(axis=0).tolist() == shards and (matrix >= 0).all()


def test_draws_follow_the_hypergeometric_law(monkeypatch):
    rng = np.random.default_rng(1)
    small = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    monkeypatch.setattr(sharding, "_NUMPY_LIMIT", 10)
    large = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    for sample in (small, large):
        assert abs(np.mean(sample) - 6) < 0.15 and abs(np.var(sample) - 20 * 0.3 * 0.7 * 80 / 99) < 0.35


@pytest.mark.parametrize("per_block", [4, 1024])
def test_all_rows_in_shards_of_exact_size(spark, odd, monkeypatch, per_block):
    monkeypatch.setattr(sharding, "ROWS_PER_BLOCK", per_block)
    df = corpora.clashing(odd.unionAll(odd).unionAll(odd))
    rows = sharding.shuffle_into_shards(df, 5).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 5
    for shard, size in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(size))
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_no_rows_and_few_rows(spark, empty, odd):
    assert sharding.shuffle_into_shards(empty, 4).count() == 0
    assert sorted(r["slot"] for r in sharding.shuffle_into_shards(odd.limit(3), 16).collect()) == [0, 0, 0]


def test_the_shuffle_is_even_and_repeatable(spark):
    df = corpora.documents(spark, [(i, f"text {i}") for i in range(4000)])
    first = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shuffle_into_shards(df, 4, seed=1).collect()}
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shuffle_into_shards(df.repartition(7), 4, seed=1).collect()}
    other = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shuffle_into_shards(df, 4, seed=2).collect()}
    assert first == again != other
    early = sum(1 for d, (s, _) in first.items() if d < 2000 and s < 2)
    assert abs(early - 1000) < 5 * (4000 / 16) ** 0.5
    assert abs(np.corrcoef(list(first), [slot for _, slot in first.values()])[0, 1]) < 0.08


def water_filled(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left, mass = total - sum(capped.values()), sum(weight[s] for s in free)
        share = {s: left * weight[s] / mass for s in free}
        over = {s: most * sizes[s] for s in free if share[s] > most * sizes[s]}
        if not over:
            return capped | share
        capped |= over


def sourced(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("seed", range(6))
def test_targets_are_filled_like_water(spark, seed):
    rng = random.Random(seed)
    sizes = {name: rng.choice([0, 1, 50, 700, 9000]) for name in ["a", "B", "é", "zz", "", None, "c"][: rng.randrange(1, 8)]}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    want = water_filled(sizes)
    assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


@pytest.mark.parametrize("per_block", [10, 1024])
def test_sources_come_near_their_targets(spark, monkeypatch, per_block):
    monkeypatch.setattr(mixing, "ROWS_PER_BLOCK", per_block)
    rng = random.Random(2)
    rows = [(i, corpora.sentence(rng, rng.randrange(0, 60), 99), rng.choices(["a", "b", "c", None], [70, 10, 3, 17])[0]) for i in range(900)]
    drawn = mixing.draws(sourced(spark, rows)).select("row.source", "size", "source_size", "target", "taken", "copies").collect()
    assert len(drawn) == 900
    for source in ("a", "b", "c", None):
        own = [r for r in drawn if r["source"] == source]
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 2
        assert all(r["taken"] == len(r["copies"]) * r["size"] <= 3 * r["size"] for r in own)
    shards = Counter(c["shard"] for r in drawn for c in r["copies"])
    assert set(shards) <= set(range(16)) and all(0 <= s < 16 for s in shards)


@pytest.mark.parametrize("per_block", [40, 1024])
def test_a_very_long_row_does_not_end_the_draw(spark, monkeypatch, per_block):
    monkeypatch.setattr(mixing, "ROWS_PER_BLOCK", per_block)
    rng = random.Random(6)
    rows = [(i, corpora.sentence(rng, rng.randrange(1, 400), 99), ["a", "b", "c", None][i % 4]) for i in range(1200)]
    long = corpora.sentence(rng, 30_000, 99)
    for source in ("a", "b", "c", None):  # early in the order of digests
        early = min(range(10_000, 10_400), key=lambda i: hashlib.md5(f"{i}|{long}".encode()).hexdigest())
        rows.append((early, long, source))
    drawn = mixing.draws(sourced(spark, rows)).select("row.*", "size", "target", "taken", "copies").collect()
    assert Counter(r["doc_id"] for r in drawn) == Counter(r[0] for r in rows)
    for source in ("a", "b", "c", None):
        own = [r for r in drawn if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 100  # half an ordinary row
        assert all(r["taken"] == len(r["copies"]) * r["size"] <= 3 * r["size"] for r in own)
    assert all(0 <= c["shard"] < 16 for r in drawn for c in r["copies"])


def test_rows_that_fit_are_drawn_before_long_ones_are_left(spark):
    """Ordinary rows cannot fill the gap by themselves, so one level of longer rows is drawn up to it."""
    rng = random.Random(8)
    sizes = [*[3_000] * 12, *[200] * 20, 9]
    rows = [(i, corpora.sentence(rng, n, 99), source) for source in ("a", "b", "c") for i, n in enumerate(sizes)]
    long = corpora.sentence(rng, 30_000, 99)
    early = min(range(10_000, 10_400), key=lambda i: hashlib.md5(f"{i}|{long}".encode()).hexdigest())
    rows += [(early, long, source) for source in ("a", "b", "c")]
    drawn = mixing.draws(sourced(spark, rows)).where("source = 'c'").select("size", "target", "taken").collect()
    assert abs(sum(r["taken"] for r in drawn) - drawn[0]["target"]) <= 1_500
    assert all(r["taken"] == r["size"] for r in drawn if r["size"] <= 200)


def test_few_rows_come_near_too(spark):
    """Ten rows a source, one of them far longer: others are drawn around it, which one exchange need not make up for."""
    rng = random.Random(9)
    rows = []
    for s, source in enumerate("abcdefgh"):
        sizes = [rng.randrange(40, 460) for _ in range(9)] + [2_000]
        rows += [(10 * s + i, corpora.sentence(rng, n, 99), source) for i, n in enumerate(sizes)]
    drawn = mixing.draws(sourced(spark, rows)).select("row.source", "size", "source_size", "target", "taken").collect()
    for source in "abcdefgh":
        own = [r for r in drawn if r["source"] == source]
        miss = sum(r["taken"] for r in own) - own[0]["target"]
        assert abs(miss) <= 1_000  # half the longest row
        assert all(r["taken"] % r["size"] == 0 and r["taken"] <= 3 * r["size"] for r in own)


def test_the_exchange_is_the_best_of_all_pairs(spark):
    rng = random.Random(10)
    rows = []
    for block in range(40):
        off_by = rng.choice([-1, 1]) * rng.randrange(1, 60) + rng.choice([0.0, 0.25])
        rows += [("s", block, f"{block}-{i}", rng.randrange(0, 90), rng.random() < 0.6, off_by) for i in range(rng.randrange(1, 9))]
    rows += [("s", 99, "same", 5, True, -5.0), ("s", 99, "same", 5, False, -5.0)]  # a digest that occurs twice
    df = spark.createDataFrame(rows, "source string, block long, digest string, size long, once boolean, off_by double")
    got = {r["block"]: (r["leaves"], r["enters"]) for r in mixing._exchange(df).collect()}
    sizes = {d: n for _, _, d, n, _, _ in rows}
    for block in range(40):
        own = [r for r in rows if r[1] == block]
        off_by, ins = own[0][5], [(d, n) for _, _, d, n, once, _ in own if once]
        outs = [(d, n) for _, _, d, n, once, _ in own if not once] + [(None, 0)]
        best = min([abs(off_by - (m - n)) for _, n in ins for _, m in outs], default=abs(off_by))
        if best < abs(off_by):
            leaves, enters = got[block]
            assert abs(off_by - (sizes.get(enters, 0) - sizes[leaves])) == best
        else:
            assert block not in got
    assert 99 not in got


def test_quotas_are_split_exactly():
    split = np.array(mixing.split_quotas([7, 0, 100, 31], 16, 3))
    assert split.sum(axis=1).tolist() == [7, 0, 100, 31]
    assert split.sum(axis=0).max() - split.sum(axis=0).min() <= 1 and (split >= 0).all()


def test_reruns_agree_and_odd_rows_have_an_answer(spark, odd, empty):
    df = corpora.clashing(odd).unionByName(corpora.clashing(odd))
    answers = [
        sorted(map(tuple, mixing.draws(x).select("row.doc_id", "row.text", "size", "taken", F.size("copies")).collect()), key=repr)
        for x in (df, df.repartition(5))
    ]
    assert answers[0] == answers[1] and len(answers[0]) == 2 * len(corpora.odd_rows())
    assert mixing.draws(empty).count() == 0 and mixing.mixed(empty).count() == 0
    mixed = mixing.mixed(df)
    assert mixed.count() == sum(a[-1] for a in answers[0]) and set(mixed.columns) == set(df.columns)
