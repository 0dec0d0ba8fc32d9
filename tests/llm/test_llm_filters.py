"""Quality network, weak supervision, languages, decontamination."""

import random
from collections import Counter

import corpora
import numpy as np
import pytest
from pyspark.sql import functions as F

from estratos.llm import decontamination, languages, quality, rules
from estratos.llm.common import read


# --- quality ------------------------------------------------------------------------------------------


def test_held_out_labels_are_predicted(spark):
    sf = "/root/testdata/sf0.01"
    scored = quality.op1_quality_network(spark, sf).join(read(spark, sf, "labels"), "doc_id").where("held_out")
    right = scored.select(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right >= 0.95


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(1)
    rows = [(i, corpora.sentence(rng, 40, 300) if i % 3 else " ".join(w + "%%%" for w in corpora.sentence(rng, 40, 300).split())) for i in range(600)]
    docs = corpora.documents(spark, rows)
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 3 > 0, 1).otherwise(0).alias("quality"))
    return docs, labels, quality.fit(docs, labels, docs)


def test_scores_of_odd_rows(fitted, odd, empty):
    _, _, model = fitted
    df = corpora.clashing(odd)
    rows = quality.score(df, *model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows) and set(df.columns) == set(rows[0].asDict())
    blank = {r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}
    assert len(blank) == 1 and quality.score(empty, *model).count() == 0


def test_accepted_rows_are_those_with_the_score(fitted):
    docs, labels, model = fitted
    kept = quality.accepted(docs, *model, 0.5)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(600) if i % 3]


def test_the_sample_is_bounded_and_the_same_for_any_partitioning(fitted):
    docs, labels, (vectors, _) = fitted
    one = quality.labelled_features(docs, labels, vectors, 50).select("doc_id").collect()
    two = quality.labelled_features(docs.repartition(9), labels, vectors, 50).select("doc_id").collect()
    assert 40 < len(one) <= 50 and sorted(one) == sorted(two)


def test_vectors_do_not_depend_on_partitions(fitted):
    docs, _, (vectors, _) = fitted
    assert np.array_equal(vectors, quality.word_vectors(docs.repartition(5)))


def test_without_labels_or_documents(spark, fitted, odd, empty):
    docs, labels, _ = fitted
    model = quality.fit(docs, labels.limit(0), docs)
    assert {r["score"] for r in quality.score(odd, *model).collect()} == {0.5}
    ones = labels.withColumn("quality", F.lit(1)).unionAll(labels.limit(3)).unionAll(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, quality int"))
    assert all(r["score"] > 0.9 for r in quality.score(odd, *quality.fit(docs, ones.where("quality = 1"), docs)).collect())
    assert quality.score(odd, *quality.fit(empty, labels, empty)).count() == odd.count()


def test_temperature_calibrates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 4))
    y = (rng.random(4000) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    p = quality.fit_network(x[:2000], y[:2000]).probability(x[2000:])
    for low, high in ((0.1, 0.4), (0.4, 0.6), (0.6, 0.9)):
        inside = (p >= low) & (p < high)
        assert abs(p[inside].mean() - y[2000:][inside].mean()) < 0.12


# --- rules --------------------------------------------------------------------------------------------


def measured(text):
    x = text or ""
    words = x.encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in x.split("\n") if line.encode().split()]
    return (
        len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in x), len(lines), len(lines) - len(set(lines)),
        len(covered), sum("A" <= c <= "Z" for c in x), x.count("!"),
    )


def test_measures_are_those_of_plain_python(spark, odd):
    rng = random.Random(4)
    rows = corpora.odd_rows() + [(100 + i, "".join(rng.choice("aab \n\t#!É") for _ in range(rng.randrange(80)))) for i in range(150)]
    got = rules.measures(corpora.documents(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((d, *measured(t)) for d, t in rows), key=repr)


def test_estimation_recovers_reliable_rules():
    rng = random.Random(5)
    patterns = Counter()
    for _ in range(20000):
        good = rng.random() < 0.8
        patterns[tuple(0 if rng.random() < 0.3 else (1 if rng.random() < (0.98 if good else 0.3) else -1) for _ in range(4))] += 1
    start, each = rules.estimate(sorted(patterns.items()))
    assert abs(start - np.log(4)) < 0.25
    assert all(abs(bad - np.log(0.02 / 0.7)) < 0.4 and abs(good - np.log(0.98 / 0.3)) < 0.3 for good, bad in each)


def test_estimation_of_nothing():
    assert np.isfinite(rules.estimate([])[0]) and rules.estimate([((0, 0), 5)])[1][0][1] < 0


def test_verdicts(spark, odd, empty):
    rows = rules.judge(corpora.clashing(odd)).collect()
    assert len(rows) == odd.count() and all(r["base_failed"] for r in rows if r["n_words"] < 50)
    assert not any(r["kept"] and r["base_failed"] for r in rows) and rules.judge(empty).count() == 0


def test_labelled_documents_are_kept_or_not(spark):
    sf = "/root/testdata/sf0.01"
    judged = rules.op4_weak_supervision(spark, sf).join(read(spark, sf, "labels"), "doc_id").where("not base_failed")
    right = judged.select(F.avg((F.col("kept").cast("int") == F.col("quality")).cast("double"))).first()[0]
    assert right >= 0.95


# --- languages ----------------------------------------------------------------------------------------


def test_held_out_languages_are_predicted(spark):
    sf = "/root/testdata/sf0.01"
    found = languages.op5_mixture_languages(spark, sf).join(read(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    right = found.where("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.95


def test_mixed_texts_have_both_languages(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents").where("length(text) between 2000 and 6000")
    model = languages.learn(docs)
    texts = {r["lang"]: r["text"] for r in docs.where("lang in ('de', 'fr')").groupBy("lang").agg(F.first("text").alias("text")).collect()}
    mixture = model.infer(languages.trigrams(np.frombuffer((texts["de"][:1500] + " " + texts["fr"][:1500]).encode(), np.uint8)))
    assert set(mixture) == {"de", "fr"} and all(0.3 < share < 0.7 for share in mixture.values())


def plain_trigrams(text):
    out = [32]
    for byte in (text or "").encode():
        c = byte + 32 if 65 <= byte <= 90 else byte if 97 <= byte <= 122 or byte >= 128 else 32
        if c != 32 or out[-1] != 32:
            out.append(c)
    if out[-1] != 32:
        out.append(32)
    return [tuple(out[i : i + 3]) for i in range(len(out) - 2)]


def plain_mixture(text, counts):
    """Mixture inference with dictionaries; `counts` has a Counter of trigrams for each language."""
    known, langs = set().union(*counts.values()), sorted(counts)
    total = {lang: sum(own.values()) + 0.5 * len(known) for lang, own in counts.items()}
    doc = Counter(t for t in plain_trigrams(text) if t in known)
    if not doc:
        return dict.fromkeys(langs, 1 / len(langs)) if plain_trigrams(text) else {}
    chance = {(lang, t): (counts[lang][t] + 0.5) / total[lang] for lang in langs for t in doc}

    def proportions(members, start):
        share = {lang: start[lang] / sum(start[m] for m in members) for lang in members}
        for _ in range(12):
            mixed = {t: sum(share[lang] * chance[lang, t] for lang in members) for t in doc}
            share = {lang: sum(n * share[lang] * chance[lang, t] / mixed[t] for t, n in doc.items()) / sum(doc.values()) for lang in members}
        return share

    def likelihood(share):
        return sum(n * np.log(sum(s * chance[lang, t] for lang, s in share.items())) for t, n in doc.items())

    best = max(langs, key=lambda lang: likelihood({lang: 1.0}))
    chosen, value = {best: 1.0}, likelihood({best: 1.0})
    everything = proportions(langs, dict.fromkeys(langs, 1.0))
    order = [best, *sorted((lang for lang in langs if lang != best), key=lambda lang: -everything[lang])]
    for size in range(2, len(order) + 1):
        share = proportions(order[:size], {lang: max(everything[lang], 1e-3) for lang in order[:size]})
        gained = likelihood(share) - 4.0 * (size - 1) * np.log2(sum(doc.values()) + 1)
        if gained <= value:
            break
        chosen, value = share, gained
    return chosen


def script(rng, first, letters, words):
    """Words of a made-up language: two to five of so many characters from `first` on."""
    return " ".join("".join(chr(first + rng.randrange(letters)) for _ in range(rng.randrange(2, 6))) for _ in range(words))


def test_mixtures_are_those_of_plain_python(spark, monkeypatch):
    rng = random.Random(12)
    kinds = {"aa": (97, 9), "bb": (97, 14), "cc": (0x4E00, 3000), "dd": (0x5200, 3000)}
    rows = [(script(rng, *kinds[lang], 120), lang) for lang in kinds for _ in range(8)] + [(None, "aa"), ("", "bb"), ("x y", None), ("?!", "ee")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    counts = {}
    for text, lang in rows:
        if lang is not None and plain_trigrams(text):
            counts.setdefault(lang, Counter()).update(plain_trigrams(text))
    model = languages.learn(docs.repartition(3))
    stored = Counter()
    for i, code in enumerate(model.known.tolist()):
        for at in range(model.begin[i], model.begin[i + 1]):
            stored[model.langs[model.lang[at]], (code >> 16, code >> 8 & 255, code & 255)] += 1
    assert set(stored) == {(lang, t) for lang, own in counts.items() for t in own} and set(stored.values()) == {1}
    assert len(model.known) > 4000  # the exact trigrams of scripts with many characters
    texts = [script(rng, *kinds[a], 40) + " " + script(rng, *kinds[b], n) for a in kinds for b in kinds for n in (1, 15, 60)]
    for text in [*texts, "a", "é", "ab cd, ab!", "ЖЖ", "x" * 3000]:
        got = model.infer(languages.trigrams(np.frombuffer(text.encode(), np.uint8)))
        wanted = plain_mixture(text, counts)
        assert set(got) == set(wanted) and all(abs(got[lang] - wanted[lang]) < 1e-9 for lang in got), text


def test_counts_do_not_depend_on_how_many_a_task_holds(monkeypatch):
    import pyarrow as pa

    rng = random.Random(13)
    rows = [(script(rng, 0x4E00, 500, 30), rng.choice("ab")) for _ in range(60)]
    batch = pa.record_batch([pa.array([r[i] for r in rows]) for i in (0, 1)], names=["text", "lang"])

    def counted():
        total = Counter()
        for part in languages._count(iter([batch, batch])):
            for lang, code, n in zip(*(c.to_pylist() for c in part.columns), strict=True):
                total[lang, code] += n
        return total

    whole = counted()
    monkeypatch.setattr(languages, "HELD_COUNTS", 50)
    assert counted() == whole and sum(whole.values()) == 2 * sum(len(plain_trigrams(t)) for t, _ in rows)


def test_odd_texts_and_no_training(spark, odd, empty):
    model = languages.learn(corpora.clashing(odd))
    rows = languages.identify(corpora.clashing(odd), model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    und = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert {1, 2, 3, 13} <= und and not {4, 7, 12, 0} & und
    assert {r["lang_pred"] for r in languages.identify(odd, languages.learn(empty)).collect()} == {"und"}
    assert languages.identify(empty, model).count() == 0


# --- decontamination ----------------------------------------------------------------------------------


def hit_words(rows, items, span):
    def split(text):
        out, word = [], ""
        for c in (text or "") + " ":
            c = c.lower() if "A" <= c <= "Z" else c
            if c in "abcdefghijklmnopqrstuvwxyz0123456789" or ord(c) > 127:
                word += c
            elif word:
                out.append(word)
                word = ""
        return out

    windows = {}
    for item, text in items:
        words = split(text)
        if item is not None and words:
            n = min(span, len(words))
            for i in range(len(words) - n + 1):
                windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    out = []
    for d, text in rows:
        words, hit, found = split(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if own := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= own
        out.append((d, len(words), len(hit), sorted(found)))
    return sorted(out, key=repr)


def found_hits(docs, benchmark, span=10):
    rows = decontamination.contaminated(docs, benchmark, span).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in rows), key=repr)


def benchmark_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("seed", [1, 2])
def test_hits_are_those_of_all_windows(spark, seed):
    rng = random.Random(seed)
    items = [(i, corpora.sentence(rng, rng.choice([1, 3, 9, 10, 11, 25]), 12)) for i in range(12)] + [(None, "w1 w2"), (50, None), (51, "!?"), (3, "w1")]
    rows = [(i, corpora.sentence(rng, rng.randrange(0, 120), 12)) for i in range(40)]
    for d, text in list(rows):
        item = rng.choice(items[:12])[1]
        rows.append((d + 100, f"{text}, {item.upper()}! {text}"))
    got = found_hits(corpora.documents(spark, rows), benchmark_of(spark, items))
    assert got == hit_words(rows, items, 10)


def test_odd_documents(spark, odd, empty):
    long = corpora.odd_rows()[6][1]
    items = [(1, " ".join(long.split()[100:140])), (2, corpora.odd_rows()[8][1]), (2, "naïve ünïcode"), (3, "漢字")]
    benchmark = benchmark_of(spark, items)
    assert found_hits(corpora.clashing(odd), benchmark) == hit_words(corpora.odd_rows(), items, 10)
    assert found_hits(odd, benchmark_of(spark, [])) == hit_words(corpora.odd_rows(), [], 10)
    assert found_hits(empty, benchmark) == []
    df = corpora.clashing(odd)
    kept = decontamination.decontaminated(df, benchmark)
    assert kept.columns == df.columns and kept.count() == sum(1 for r in hit_words(corpora.odd_rows(), items, 10) if r[2] == 0)
