"""The Merkle manifest against hashlib."""

import hashlib
import random
import zlib
from collections import Counter

import corpora
import pytest

from estratos.llm import merkle

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return h("".join(field(row[c]) for c in merkle.COLUMNS))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def beside(tree, i):
    for level in tree[:-1]:
        a = i // 8 * 8
        yield "".join(level[a:i]), "".join(level[i + 1 : a + 8])
        i //= 8


def brute(rows):
    told = {}
    for r in rows:
        lowered = dict(r, text=None if r["text"] is None else r["text"].translate(LOWER))
        changed = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
        told[leaf(r)] = leaf(lowered if changed else r)
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    order = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))
    own = {x: sorted((r for r in rows if r["lang"] == x), key=order) for x in langs}
    trees = {x: levels([leaf(r) for r in own[x]]) for x in langs}
    top, out = levels([trees[x][-1][0] for x in langs]), []
    for k, x in enumerate(langs):
        for i, r in enumerate(own[x]):
            path = [*beside(trees[x], i), *beside(top, k)]
            node = told[leaf(r)]
            for left, right in path:
                node = h(left + node + right)
            root = top[-1][0]
            out.append((r["doc_id"], leaf(r), trees[x][-1][0], root, h("".join(a + b for a, b in path)), node, node == root))
    return Counter(out)


def check(docs):
    want = brute([r.asDict() for r in docs.select(*merkle.COLUMNS).collect()])
    got = merkle.manifest(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert Counter(map(tuple, got)) == want
    return got


def test_odd_rows_and_clashing_columns(spark, odd):
    """Null ids, texts and languages, repeated rows and ids, very long texts, more columns with the operator's names."""
    upper = corpora.documents(spark, [(i, f"Upper {i}") for i in range(30, 50)])
    got = check(corpora.clashing(odd.unionAll(odd.limit(9)).unionAll(upper)).withColumnsRenamed({"size": "tree", "block": "rank", "class": "leaf"}))
    assert any(not r["verified"] for r in got) and any(r["verified"] for r in got)


@pytest.mark.parametrize(
    ("sizes", "levels_at_once"), [([1], 3), ([8, 1, 9], 1), ([64, 65, 8, 1], 3), ([513, 7], 3), ([1] * 11, 3)]
)
def test_sizes_around_powers_of_the_fan(spark, monkeypatch, sizes, levels_at_once):
    monkeypatch.setattr(merkle, "LEVELS", levels_at_once)
    rng = random.Random(sum(sizes))
    rows = [(rng.randrange(10**9), f"Text {rng.random()}", f"l{k:02}", "S", k) for k, n in enumerate(sizes) for _ in range(n)]
    check(spark.createDataFrame(rows, corpora.DOCUMENT).repartition(3))


def test_many_copies_of_one_row(spark):
    check(spark.createDataFrame([(7, "Same", "en", "a", 4)] * 100 + [(8, "other", "en", "a", 5)], corpora.DOCUMENT))


def test_nothing(spark, empty):
    assert merkle.manifest(empty).collect() == []


def test_a_request_for_one_leaf_looks_up_one_record_a_level(spark):
    """The descent asks for what its requests need, not for the whole tree."""
    rows = spark.createDataFrame([(0, i, h(str(i)), 100) for i in range(100)], "tree long, rank long, digest string, size long")
    records, roots = merkle.grow(rows, 100)
    (root,) = roots.collect()
    assert root["height"] == 3
    start = spark.createDataFrame([(0, root["digest"], root["digest"], 0, 3, [])], "tree long, subroot string, digest string, prefix long, height int, path array<struct<left:string,right:string>>")
    found = merkle.descend(records, start, 3)
    one = found.where("prefix = 5").collect()
    assert len(one) == 1 and one[0]["children"] == [h(str(i)) for i in range(40, 48)] and len(one[0]["path"]) == 2
