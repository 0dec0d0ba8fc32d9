"""The Jaccard join against all pairs, and connected components against a search."""

import random
import time
from itertools import combinations

import corpora
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from estratos.llm import jaccard
from estratos.llm.common import CLEANUP, written
from estratos.llm.components import connected_components


def shingles(text, size):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    label = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
            old, new = max(label[i], label[j]), min(label[i], label[j])
            label = [new if x == old else x for x in label]
    lowest = {}
    for (d, _), x in zip(rows, label, strict=True):
        lowest[x] = d if lowest.get(x) is None else lowest[x] if d is None else min(lowest[x], d)
    return [(d, len(s), lowest[x]) for (d, _), s, x in zip(rows, sets, label, strict=True)]


def found(df, size, percent):
    rows = jaccard.jaccard_components(df, size, percent).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize(("size", "percent", "seed"), [(3, 90, 1), (5, 80, 2), (1, 50, 3)])
def test_components_are_those_of_all_pairs(spark, size, percent, seed):
    rows = corpora.similar_rows(seed, 40, 9, 150, 400) + corpora.similar_rows(seed + 9, 30, 6, 12, 20)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    assert found(corpora.documents(spark, rows), size, percent) == sorted(brute(rows, size, percent), key=repr)


def test_large_neighbourhoods_are_searched_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 7)
    rows = [(i, t) for i, (_, t) in enumerate(corpora.similar_rows(4, 3, 60, 90, 300))]
    assert found(corpora.documents(spark, rows), 3, 90) == sorted(brute(rows, 3, 90), key=repr)


def test_odd_rows(spark, odd):
    assert found(odd, 3, 90) == sorted(brute(corpora.odd_rows(), 3, 90), key=repr)


def test_clashing_columns_and_no_rows(spark, odd, empty):
    assert jaccard.jaccard_components(corpora.clashing(odd)).count() == odd.count()
    assert jaccard.jaccard_components(empty).count() == 0 and jaccard.deduplicate(empty).count() == 0


def test_one_row_of_each_group_stays(spark, odd):
    df = corpora.clashing(odd)
    kept = jaccard.deduplicate(df, 5, 80)
    assert kept.columns == df.columns
    ids = sorted(((r["doc_id"], (r["text"] or "")[:5]) for r in kept.collect()), key=repr)
    wanted = {(d, (t or "")[:5]) for d, t in corpora.odd_rows()}
    wanted -= {(6, "one"), (10, "w267 "), (11, "start"), (None, corpora.odd_rows()[8][1][:5])}
    wanted = {x for x in wanted if x[0] not in (10,)}
    assert ids == sorted(wanted, key=repr)


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_similar_sets_share_a_part(percent):
    """The guarantee behind the candidate search, for sets at the limit of similarity."""
    rng, parts = random.Random(percent), jaccard.Parts(percent)
    for _ in range(400):
        n = rng.randrange(1, 300)
        base = [rng.getrandbits(64) for _ in range(n)]
        differ = rng.randrange(0, parts.differences(n, n) + 1)
        gone = rng.choice([0, differ, rng.randrange(0, differ + 1)])
        other = base[gone:] + [rng.getrandbits(64) for _ in range(differ - gone)]
        a, b = (np.unique(np.array(x, dtype=np.uint64)) for x in (base, other))
        both = len(np.intersect1d(a, b))
        if 100 * both >= percent * (len(a) + len(b) - both) and len(a) and differ:
            assert set(parts.keys(a).tolist()) & set(parts.keys(b).tolist())
            (first, least), (second, fewest) = parts.prefix(a), parts.prefix(b)
            assert len(np.intersect1d(first, second)) >= max(least, fewest)


def test_divide_skip_finds_a_spanning_forest():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 120).astype(np.uint64)
    sets = []
    for _ in range(60):
        own = base.copy()
        own[rng.integers(0, 120, rng.integers(0, 14))] = rng.integers(0, 2**63, 1)[0]
        sets.append(np.unique(own))
    links = jaccard.divide_skip(sets, np.zeros(60, dtype=bool), 90)
    for i, j in links:
        both = len(np.intersect1d(sets[i], sets[j]))
        assert 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both)
    forest = jaccard.Forest(60)
    assert all(forest.join(i, j) for i, j in links)
    for i, j in combinations(range(60), 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
            assert forest.root(i) == forest.root(j)


def test_components_of_random_graphs(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(50)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    label = {}
    for a, b in edges:
        if a is not None and a != b:
            label.setdefault(a, a), label.setdefault(b, b)
    for a, b in edges:
        if a is not None and a != b and label[a] != label[b]:
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = {k: new if v == old else v for k, v in label.items()}
    assert got == label


def test_components_without_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_set_of_each_candidate_class_whatever_the_ids(spark):
    """Rows that share an id, or have none, stand for their own class only; copies are not carried along."""
    rng = random.Random(2)
    base = corpora.sentence(rng, 60, 300).split()
    texts = [" ".join([*base[:30], f"x{i}", *base[31:]]) for i in range(20)] + [corpora.sentence(rng, 40, 10**6) for _ in range(20)]
    docs = spark.createDataFrame([(None if i % 2 else 7, t) for t in texts for i in range(5)], "doc_id long, text string").repartition(3)
    of_class = jaccard.written(jaccard.classes(docs, 3), "classes")
    sets = jaccard.candidate_sets(docs, of_class, 3, 80).collect()
    near = {jaccard.set_hash(s) for _, s in jaccard.shingle_sets(pa.array(texts[:20]), 3)}
    assert near <= {r["class"] for r in sets} and len(sets) <= 3 * len({r["class"] for r in sets})
    assert all(r["n"] == len(r["shingles"]) for r in sets)


@pytest.mark.parametrize("most", [64, 1 << 26])
def test_the_bit_map_holds_all_its_keys(spark, monkeypatch, most):
    """At its largest size it lets more through, and never less."""
    monkeypatch.setattr(jaccard, "MOST_BITS", most)
    rng = random.Random(9)
    keys = [rng.randrange(-(2**63), 2**63) for _ in range(500)]
    bits = jaccard.membership(spark.createDataFrame([(k,) for k in keys], "row_key long"))
    assert 64 * len(bits) <= most and 64 * len(bits) & (64 * len(bits) - 1) == 0
    at = np.array(keys, dtype=np.int64).view(np.uint64) & np.uint64(64 * len(bits) - 1)
    assert ((bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all()


def test_a_template_without_links(spark):
    """Texts of one template that share parts, so that all are one neighbourhood, and of which no two are similar."""
    rng = random.Random(5)
    base, rows = corpora.sentence(rng, 300, 10**6).split(), []
    for i in range(250):
        own = list(base)
        for at in rng.sample(range(300), 8):
            own[at] = f"e{rng.randrange(10**9)}"
        rows.append((i, " ".join(own)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 90) == sorted(brute(rows, 3, 90), key=repr)


def test_rows_without_id(spark):
    rng = random.Random(9)
    base = corpora.sentence(rng, 120, 10**6)
    rows = [(None, f"{base} e{i}") for i in range(40)] + [(1, f"{base} f")]
    assert found(corpora.documents(spark, rows), 3, 90) == sorted(brute(rows, 3, 90), key=repr)


def test_ties_are_found_with_a_partial_step(spark, monkeypatch):
    """A part that most sets share: no window gathers its rows, and the neighbourhoods are those of all pairs."""
    plans = []
    keep = lambda edges: (plans.append(edges._jdf.queryExecution().toString()), connected_components(edges))[1]
    monkeypatch.setattr(jaccard, "connected_components", keep)
    rng = random.Random(10)
    base = rng.sample(range(1, 2**62), 200)
    sets = [(i, sorted(set(base[: 200 - i % 3] + [i + 1]))) for i in range(60)]
    near = jaccard.neighbourhoods(spark.createDataFrame(sets, "class bigint, shingles array<bigint>"), 90).collect()
    assert {r["node"] for r in near} == set(range(60)) and {r["component"] for r in near} == {0}
    assert "Window" not in plans[0] and "Join" in plans[0]


def crossing_sets(rng, groups, sizes):
    """Sets that share halves with others, so that parts tie them, and for each a near copy of one shingle more."""
    halves = [[rng.sample(range(1, 2**62), n // 2) for n in sizes] for _ in range(groups)]
    sets = [set(a[k] + b[k]) for k in range(len(sizes)) for a, b in combinations(halves, 2)]
    sets += [s | {rng.randrange(2**62)} for s in sets]
    return [(i, sorted(s)) for i, s in enumerate(sets)]


def neighbours(spark, sets, percent):
    near = jaccard.neighbourhoods(spark.createDataFrame(sets, "class bigint, shingles array<bigint>"), percent).collect()
    found = {}
    for node, component in map(tuple, near):
        found.setdefault(component, set()).add(node)
    return sorted(map(sorted, found.values()))


@pytest.mark.parametrize("block", [2, 1 << 14])
@pytest.mark.parametrize("percent", [80, 90])
def test_a_common_part_alone_makes_no_neighbourhood(spark, monkeypatch, percent, block):
    """Neighbourhoods are as large as the groups of near copies, however many sets share parts with one another."""
    monkeypatch.setattr(jaccard, "TIE_SETS", block)
    sets = crossing_sets(random.Random(12), 12, (40, 90, 200))
    assert neighbours(spark, sets, percent) == [[i, i + len(sets) // 2] for i in range(len(sets) // 2)]


@pytest.mark.parametrize("few", [2, 8])
def test_prints_tie_all_similar_sets(spark, monkeypatch, few):
    """Sets of sizes on both sides of a power of two, with similarities from below to above the least one."""
    monkeypatch.setattr(jaccard, "FEW", few)
    rng = random.Random(13)
    sets = []
    for n in (7, 30, 62, 66, 126, 130, 250, 262):
        base = rng.sample(range(1, 2**62), n)
        sets += [set(base[: n - rng.randrange(n // 5 + 1)] + rng.sample(range(2**62), rng.randrange(n // 8 + 1))) for _ in range(12)]
    linked = [(i, j) for i, j in combinations(range(len(sets)), 2) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and sets[i] != sets[j]]
    of = {x: k for k, group in enumerate(neighbours(spark, [(i, sorted(s)) for i, s in enumerate(sets)], 80)) for x in group}
    assert len(linked) > 100 and all(of[i] == of[j] for i, j in linked)


def test_shuffle_files_go_when_a_write_ends(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {str(x) for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}

    before, had = files(), spark.conf.get(CLEANUP)
    assert len(written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts").collect()) == 7
    for _ in range(60):
        if not (left := files() - before):
            break
        time.sleep(0.5)
    assert not left and spark.conf.get(CLEANUP) == had
