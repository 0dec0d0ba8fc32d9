"""The registered queries: names, columns, their SQL, and the pipeline against plain Python."""

import random
import re
import sys
from collections import Counter
from pathlib import Path

import corpora
import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from estratos.llm import jaccard, mixing, quality
from estratos.llm.common import read
from estratos.llm.queries import ORACLES, QUERIES
from verify import TABLES, compare

sys.path.insert(0, str(Path(__file__).resolve().parent))
from test_llm_filters import hit_words  # noqa: E402
from test_llm_jaccard import brute  # noqa: E402

COLUMNS = {
    1: {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    2: {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    3: {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    4: {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    5: {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    6: {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    7: {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    8: {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    9: {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    10: {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    11: {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    12: {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    13: {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
}


def test_one_query_per_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_columns_and_one_row_per_row(spark, sf, name):
    df = QUERIES[name](spark, sf)
    wanted = COLUMNS[int(re.match(r"op(\d+)_", name)[1])]
    assert wanted.items() <= dict(df.dtypes).items()
    if "rank" in wanted:  # ten results for each query: here every query has that many
        queries = read(spark, sf, "benchmark") if "item_id" in wanted else read(spark, sf, "embeddings").where("vec_id % 100 = 0")
        assert df.count() == 10 * queries.count()
        return
    table = "pages" if "page_id" in wanted else "documents"
    assert df.count() == read(spark, sf, table).count()


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_agree_with_sql(spark, name, sf):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf}/{table}.parquet')")
    wanted = [d[0] for d in con.execute(ORACLES[name]).description]
    outcome = compare(spark, con, lambda s, d: QUERIES[name](s, d).select(*wanted), ORACLES[name], sf)
    assert outcome.startswith("ok"), outcome


def test_stages(spark, tmp_path):
    """Each stage against plain Python over its own input, with columns kept and repeated and odd rows in it."""
    rng = random.Random(7)
    rows = [(i, t) for i, (_, t) in enumerate(corpora.similar_rows(5, 25, 5, 120, 400))]
    rows += [(1000 + i, " ".join(w + "%%%" for w in corpora.sentence(rng, 40, 400).split())) for i in range(30)]
    items = [(i, corpora.sentence(rng, 14, 400)) for i in range(5)]
    rows += [(2000 + i, f"{corpora.sentence(rng, 50, 400)} {items[i % 5][1]} {corpora.sentence(rng, 9, 400)}") for i in range(8)]
    rows += [(d, t) for d, t in corpora.odd_rows() if t is None or len(t) < 10_000] + rows[:3]
    docs = corpora.documents(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(d, int("%%%" not in (t or "")), 0) for d, t in rows if d is not None and (d < 900 or 1000 <= d < 1030)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sf = str(tmp_path)
    docs = read(spark, sf, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = dict(corpus_pipeline.STAGES)

    accepted = stage[names[0]](spark, docs, sf)
    vectors, network = quality.fit(docs, read(spark, sf, "labels").where("crc32(cast(doc_id as string)) % 5 <> 0"), docs)
    scored = quality.score(docs, vectors, network).where("score >= 0.3").drop("score")
    assert Counter(map(tuple, accepted.collect())) == Counter(map(tuple, scored.select(docs.columns).collect()))
    assert not any("%%%" in (r["text"] or "") for r in accepted.collect())

    single = stage[names[1]](spark, docs, sf)
    unique = list({tuple(r): None for r in docs.collect()})
    marked = [(i, r[1]) for i, r in enumerate(unique)]
    component = [c for _, _, c in brute(marked, 5, 80)]
    groups = {}
    for r, c, (_, n, _) in zip(unique, component, brute(marked, 5, 80), strict=True):
        groups.setdefault(c, []).append((r, n))
    got = Counter(map(tuple, single.collect()))
    for members in groups.values():
        if members[0][1] == 0:
            assert all(got[r] == sum(1 for x in docs.collect() if tuple(x) == r) for r, _ in members)
        else:
            assert sum(got[r] for r, _ in members) == 1
            (stays,) = [r for r, _ in members if got[r]]
            ids = [r[0] for r, _ in members if r[0] is not None]
            assert not ids or stays[0] == min(ids)

    clean = stage[names[2]](spark, docs, sf)
    hit = {d for d, _, n, _ in hit_words([tuple(r)[:2] for r in docs.collect()], items, 10) if n}
    assert Counter(map(tuple, clean.collect())) == Counter(tuple(r) for r in docs.collect() if r["doc_id"] not in hit)

    mixed = stage[names[3]](spark, docs, sf)
    copies = Counter()
    for r in mixing.draws(docs).select("row.*", "taken", "size", "copies").collect():
        copies[tuple(r)[:5]] += len(r["copies"])
    assert Counter(map(tuple, mixed.collect())) == +copies and mixed.schema.names == docs.columns

    sharded = stage[names[4]](spark, docs, sf).collect()
    assert Counter(tuple(r)[:5] for r in sharded) == Counter(map(tuple, docs.collect()))
    assert {"shard", "slot"} <= set(sharded[0].asDict())

    whole = corpus_pipeline.run(spark, sf)
    assert 0 < whole.count() and set(docs.columns) < set(whole.columns)
    assert not any("%%%" in (r["text"] or "") for r in whole.collect())


def test_pipeline_of_nothing(spark, tmp_path, empty):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_extra_columns_go_through_the_filters(spark, odd):
    df = corpora.clashing(odd)
    assert jaccard.deduplicate(df).schema == df.schema
