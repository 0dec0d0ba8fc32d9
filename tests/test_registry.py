"""Every registered query against its SQL, and the coverage of the inventory."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from registry import all_entries
from registry.coverage import ROOT, SECTIONS, implementations, markdown
from verify import TABLES, compare

INVENTORY = [i for _, ids in SECTIONS for i in ids]


def test_every_inventory_id_has_a_query():
    covered = {i for e in all_entries().values() for i in e.ids}
    assert [i for i in INVENTORY if i not in covered] == []
    assert covered <= set(INVENTORY)


def test_every_inventory_id_has_an_implementation():
    code = implementations()
    assert [i for i in INVENTORY if not code[i]] == []


def test_the_coverage_page_is_current():
    assert (ROOT / "COVERAGE.md").read_text("utf-8") == markdown()


def test_only_the_sketch_lacks_sql():
    assert set(all_entries()) - set(oracle_sql()) == {"load_metrics_approximate"}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('/root/testdata/sf0.001/{name}.parquet')"
        )
    return connection


@pytest.mark.parametrize("name", list(all_entries()))
def test_query_agrees_with_sql(spark, sf, con, name):
    assert compare(spark, con, queries()[name], oracle_sql().get(name), sf).startswith("ok")


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["year", "total_visitors", "total_spending_usd", "yoy_pct"] and df.count() == 7
