"""Repeated passages against all windows."""

import hashlib
import random

import corpora
import pytest

from estratos.llm import substrings


def brute(rows, length):
    last = (1 << 63) - 1
    parts = [((last if d is None else d), (t or "").encode().split()) for d, t in rows]
    least = {}
    for d, words in parts:
        for i in range(len(words) - length + 1):
            key = tuple(words[i : i + length])
            least[key] = min(least.get(key, d), d)
    out = []
    for (d, words), (own, _) in zip(parts, rows, strict=True):
        gone = set()
        for i in range(len(words) - length + 1):
            if least[tuple(words[i : i + length])] < d:
                gone.update(range(i, i + length))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((own, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df, length):
    rows = substrings.repeated_passages(df, length).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize(("length", "seed"), [(50, 1), (12, 2)])
def test_removed_words_are_those_of_all_windows(spark, length, seed):
    rng = random.Random(seed)
    passages = [corpora.sentence(rng, rng.randrange(length - 3, 3 * length), 200) for _ in range(6)]
    rows = []
    for d in rng.sample(range(1000), 60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else corpora.sentence(rng, rng.randrange(0, 90), 200) for _ in range(4)]
        rows.append((d, " ".join(parts)))
    rows += [(rng.randrange(1000, 2000), t) for _, t in rows[:10]]
    assert found(corpora.documents(spark, rows), length) == brute(rows, length)


def test_a_window_across_two_references_is_found_in_a_third(spark):
    rng = random.Random(8)
    a, b, c, d = (corpora.sentence(rng, 40, 10**6) for _ in range(4))
    rows = [(1, f"{a} {b} x"), (2, f"y {c} {d}"), (3, f"z {b} {c} z"), (4, f"{a} {b} {c} {d}")]
    assert found(corpora.documents(spark, rows), 50) == brute(rows, 50)


def test_odd_rows(spark, odd):
    assert found(odd, 50) == brute(corpora.odd_rows(), 50)


def test_clashing_columns_and_no_rows(spark, odd, empty):
    assert found(corpora.clashing(odd), 50) == brute(corpora.odd_rows(), 50) and found(empty, 50) == []


def test_factors_are_runs_with_one_reference():
    import numpy as np

    spans = substrings.factors(np.array([3, 4, 5, 9, 6]), np.array([1, 1, 1, 2, 7]), 10)
    assert spans == [(3, 12, 1), (6, 10, 7), (9, 10, 2)]


def test_factors_occur_in_their_references(spark):
    x = [f"x{i}" for i in range(1, 52)]
    rows = [(1, " ".join([*x[:50], "y", *x[1:]])), (2, " ".join(x)), (3, " ".join(["z", *x[:50]]))]
    got = substrings.repeated_passages(corpora.documents(spark, rows), 50).collect()
    text = dict(rows)
    spans = {r["doc_id"]: [tuple(f) for f in r["factors"]] for r in got}
    assert spans[2] == [(0, 50, 1), (1, 50, 1)] and spans[3] == [(1, 50, 1)]
    for d, own in spans.items():
        assert all(" ".join(text[d].split()[start : start + n]) in text[reference] for start, n, reference in own)


def test_rows_without_id_meet_their_own_text_only(spark, monkeypatch):
    counts, join = [], substrings._texts_of
    monkeypatch.setattr(substrings, "_texts_of", lambda *a: (counts.append(join(*a).count()), join(*a))[1])
    rng = random.Random(9)
    shared = corpora.sentence(rng, 60, 10**6)
    rows = [(None, f"{corpora.sentence(rng, 5, 10**6)} {shared}") for _ in range(40)] + [(1, shared)]
    assert found(corpora.documents(spark, rows), 50) == brute(rows, 50)
    assert counts == [41]
