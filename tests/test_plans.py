"""Physical plans: what must and must not be in them."""

import re
from pathlib import Path

import pytest

from estratos.plans import bindings, bronze, flow
from registry import all_entries
from registry import tables as t


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    name for name, e in all_entries().items()
    if not name.startswith(("bronze_", "export_", "new_", "archived", "csv_", "parquet_", "table_", "seed_", "sorted_",
                            "source_"))
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, sf, name):
    plan = plan_of(all_entries()[name].run(spark, sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "ArrowEval" not in plan


def test_year_range_and_columns_reach_the_scan(spark, sf):
    plan = plan_of(all_entries()["arrivals_growth_filtered"].run(spark, sf))
    scan = next(line for line in plan.splitlines() if "o_orderdate" in line and "FileScan" in line)
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in scan and "LessThan(o_orderdate,2001-01-01" in scan
    assert "o_orderkey" not in scan


def test_validity_filters_are_pushed(spark, tmp_path):
    from estratos.plans import silver

    df = bindings.arrivals(spark, "/root/testdata/sf0.001").limit(10)
    df.write.parquet(f"{tmp_path}/a")
    read = spark.read.schema(df.schema).parquet(f"{tmp_path}/a")
    plan = plan_of(silver.stg_tourism_arrivals(read).select("year", "number_of_visitors"))
    for pushed in ("GreaterThanOrEqual(number_of_visitors,0)", "GreaterThanOrEqual(year,2015)",
                   "GreaterThanOrEqual(month,1)", "LessThanOrEqual(month,12)"):
        assert pushed in plan
    assert re.search(r"ReadSchema: struct<year:int,month:int,number_of_visitors:bigint>", plan)


def test_keys_are_not_hashed_when_unused(spark, sf):
    assert "md5" not in plan_of(all_entries()["arrivals_growth"].run(spark, sf))


def test_top_k_and_top_one_do_not_sort_everything(spark, sf):
    assert "TakeOrderedAndProject" in plan_of(all_entries()["top_countries"].run(spark, sf))
    latest = plan_of(all_entries()["latest_order_per_customer"].run(spark, sf))
    assert latest.count("WindowGroupLimit") == 2


def test_aggregations_have_a_partial_step(spark, sf):
    for name in ("fct_tourism_arrivals", "fct_hotel_occupancy", "net_migration", "check_unique", "airport_ranking"):
        plan = plan_of(all_entries()[name].run(spark, sf))
        assert "partial_" in plan, name


def test_hashing_not_sorting_over_line_items(spark, sf):
    plan = plan_of(t.air(spark, sf))
    items = plan[: plan.index("l_linestatus")]
    assert "HashAggregate(keys=[" in items
    assert plan.count("SortAggregate") <= 2  # only over the sums per part type


def test_the_running_total_window_sees_totals_only(spark, sf):
    plan = plan_of(all_entries()["running_sums_with_ties"].run(spark, sf))
    below = plan[plan.index("Window ["):]
    assert re.search(r"HashAggregate\(keys=\[year#\d+, quarter#\d+\]", below) or "HashAggregate(keys=[" in below


@pytest.mark.parametrize(("name", "scans"), [("running_sums_with_ties", 2), ("fct_tourism_balance", 2), ("gold_quality_report", 4)])
def test_running_totals_read_their_table_twice(spark, sf, name, scans):
    plan = all_entries()[name].run(spark, sf)._jdf.queryExecution().toString()
    plan = plan[plan.index("== Physical Plan"):]
    assert len([s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "o_totalprice" in s or "o_orderdate" in s]) <= scans


def test_window_without_partition_only_over_yearly_rows(spark, sf):
    plan = plan_of(all_entries()["arrivals_growth"].run(spark, sf))
    below = plan[plan.index("Exchange SinglePartition"):]
    assert below.splitlines()[1].strip().startswith("+- HashAggregate(keys=[year")


def test_the_lookup_against_a_table_is_not_hinted(spark, sf):
    df = all_entries()["orders_by_priority_and_region"].run(spark, sf)
    assert "strategy=broadcast" not in df._jdf.queryExecution().analyzed().toString()


def test_whole_year_writes_are_rebalanced(spark, tmp_path):
    from estratos.sources import sinks

    spark.conf.set("spark.sql.adaptive.enabled", "true")
    df = spark.range(100).selectExpr("cast(id % 3 as int) as year", "id").hint("rebalance", "year")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(df)
    assert sinks.write_parquet(spark.range(10).selectExpr("cast(id as int) as year", "id"), f"{tmp_path}/y", ["year"])["num_rows"] == 10
    assert set(flow.YEAR_PARTITIONED) <= set(t.FACTS)


def test_the_library_never_collects_or_checkpoints_locally():
    root = Path(bronze.__file__).resolve().parents[1]
    for path in root.rglob("*.py"):
        if "llm" in path.relative_to(root).parts:
            continue  # its modules state what they bring to the driver, and its bound
        text = path.read_text("utf-8")
        for word in (".collect()", "toPandas", "localCheckpoint", ".rdd", "crossJoin", "udf(", ".limit(1000"):
            assert word not in text, (path, word)
