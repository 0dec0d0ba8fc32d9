"""Operators on data in which one key holds a third of all rows, against brute force."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from estratos.operators import aggregates, joins, quality, sets, windows
from estratos.session import sized_for

N = 60_000
HOT = 7


def key(i):
    return HOT if i % 3 == 0 else i % 500


@pytest.fixture(scope="module")
def skewed(spark):
    k = F.when(F.col("id") % 3 == 0, HOT).otherwise(F.col("id") % 500).cast("int")
    return spark.range(0, N, 1, 8).select(k.alias("k"), (F.col("id") % 4 + 1).cast("int").alias("q"), "id")


@pytest.fixture
def splitting(spark):
    """Thresholds at which the small fixture counts as skewed, and no broadcast."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_join_key_is_split(spark, skewed, splitting):
    names = spark.range(500).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    joined = skewed.join(names, "k")
    counts = {r.name: r["count"] for r in joined.groupBy("name").count().collect()}
    want = Counter(f"n{key(i)}" for i in range(N))
    assert counts == want
    joined.write.format("noop").mode("overwrite").save()
    rows = joined.collect()
    assert len(rows) == N
    assert "skew=true" in final_plan(joined)


def test_lookup_of_a_hot_key_is_whole(spark, skewed, splitting):
    table = spark.createDataFrame([(str(HOT), 1.5)], "t string, v double")
    out = joins.lookup_or_default(skewed.select(F.col("k").cast("string").alias("k")), "k", table, "t", {"v": 0.0})
    got = {r.v: r["count"] for r in out.groupBy("v").count().collect()}
    hot = sum(key(i) == HOT for i in range(N))
    assert got == {1.5: hot, 0.0: N - hot}


def test_orphans(spark, skewed, splitting):
    parent = spark.range(500).where(f"id <> {HOT}").select(F.col("id").cast("int").alias("p"))
    hot = sum(key(i) == HOT for i in range(N))
    assert [tuple(r) for r in joins.orphan_keys(skewed, "k", parent, "p").collect()] == [(HOT, hot)]
    assert joins.orphan_rows(skewed, "k", parent, "p").count() == hot


def test_running_totals(skewed):
    totals = defaultdict(int)
    for i in range(N):
        totals[(key(i), i % 4 + 1)] += i
    want = {(k, q): sum(totals.get((k, p), 0) for p in range(1, q + 1)) for k, q in totals}
    got = windows.running_totals(skewed, "k", "q", {"ytd": "id"}, (1, 9999), (1, 4))
    assert got.count() == N
    assert {(r.k, r.q): r.ytd for r in got.select("k", "q", "ytd").distinct().collect()} == want


def test_running_totals_without_a_provable_bound(skewed):
    small = windows.running_totals(skewed, "k", "q", {"ytd": "id"}, (1, 9999), (1, 4))
    shuffled = windows.running_totals(skewed, "k", "q", {"ytd": "id"}, (-(2**31), 2**31), (1, 4))
    assert "broadcast" not in shuffled._jdf.queryExecution().analyzed().toString().lower()
    assert small.select(sorted(small.columns)).exceptAll(shuffled.select(sorted(shuffled.columns))).isEmpty()


def test_latest_row(skewed):
    last = {key(i): i for i in range(N)}
    got = {r.k: r.id for r in windows.latest_row(skewed, ["k"], "id").collect()}
    assert got == last


def test_distinct_counts(skewed):
    row = aggregates.totals_with_distincts(skewed, {"total": "id"}, {"keys": "k", "quarters": "q"}).first()
    assert (row.total, row["keys"], row.quarters) == (N * (N - 1) // 2, len({key(i) for i in range(N)}), 4)
    approx = aggregates.totals_with_approx_distincts(skewed, {"total": "id"}, {"ids": "id"}).first()
    assert approx.total == row.total and abs(approx.ids - N) < 0.1 * N


def test_unique_and_unseen(skewed):
    repeated = quality.failing_rows(skewed, quality.unique("k"))
    assert {r.k: r.num_rows for r in repeated.collect()} == {
        k: n for k, n in Counter(key(i) for i in range(N)).items() if n > 1
    }
    assert sets.unseen(skewed, skewed.where("id < 1000"), "k").count() == 0
    assert sets.unseen(skewed, skewed.where(f"k <> {HOT}"), "k").collect() == [(HOT,)]


def test_a_hot_year_is_written_as_several_files(spark, tmp_path, splitting):
    from estratos.sources import sinks

    df = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, 2020).otherwise(2000 + F.col("id") % 20).cast("int").alias("year"),
        F.xxhash64("id").alias("v"),
    )
    assert sinks.write_parquet(df, f"{tmp_path}/t", ["year"])["num_rows"] == 200_000
    files = list((tmp_path / "t" / "year=2020").glob("*.parquet"))
    assert len(files) > 1
    assert spark.read.schema("v bigint, year int").parquet(f"{tmp_path}/t").count() == 200_000


def test_sizes():
    tiny, huge = sized_for(10**6, 8), sized_for(100 * 10**12, 8000)
    assert tiny["spark.sql.shuffle.partitions"] == "16"
    assert huge["spark.sql.shuffle.partitions"] == "372530"
    assert sized_for(100 * 10**12, 8000, max_partitions=50_000)["spark.sql.shuffle.partitions"] == "50000"
