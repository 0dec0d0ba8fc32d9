import pytest
from pyspark.sql import functions as F

from estratos.operators import quality as q
from estratos.plans import suites
from estratos.schemas import GRAIN


@pytest.fixture
def df(rows):
    return rows(
        [(1, "a", 5.0, 1.0), (1, "b", -1.0, 20.0), (2, None, None, 0.0), (None, " ", 101.0, 90.0), (None, "a", 100.0, 100.0)],
        "id int, t string, v double, w double",
    )


CHECKS = [
    (q.not_null("t"), 1),
    (q.not_blank("t"), 2),
    (q.unique("id"), 1),
    (q.unique("t"), 1),
    (q.unique("key", ["id", "t"]), 0),
    (q.accepted_values("t", ["a", " "]), 1),
    (q.between("v", 0, 100), 2),
    (q.between("v", low=0), 1),
    (q.between("v", high=100), 1),
    (q.between("v"), 0),
    (q.not_negative("v"), 1),
    (q.not_above("v", "w"), 2),
    (q.agree_within("v", "w", 10, lambda: F.col("w") > 0), 2),
]


@pytest.mark.parametrize("check, failed", CHECKS, ids=lambda c: getattr(c, "kind", str(c)))
def test_failing_rows(df, check, failed):
    assert q.failing_rows(df, check).count() == failed


def test_report_agrees_with_the_rows(df):
    report = q.report(df, [c for c, _ in CHECKS], "t")
    assert report.columns == ["table", "check", "column", "severity", "n_failed"]
    got = sorted((r["check"], r["column"], r.n_failed) for r in report.collect())
    assert got == sorted((c.kind, c.column, n) for c, n in CHECKS)


def test_report_of_row_checks_is_one_pass(df):
    plan = q.report(df, [q.not_null("t"), q.between("v", 0), q.not_blank("t")])._jdf.queryExecution().executedPlan()
    assert plan.toString().count("partial_count_if") + plan.toString().count("partial_count(") >= 1
    assert plan.toString().count("Exchange SinglePartition") == 1


def test_report_of_an_empty_table(rows):
    report = q.report(rows([], "a int"), [q.not_null("a"), q.unique("a"), q.between("a", 0)])
    assert {r.n_failed for r in report.collect()} == {0}


def test_occupancy_ten_points_apart(rows):
    fact = rows(
        [(50.0, 40.0, 1), (50.1, 40.0, 1), (90.0, 0.0, 0), (29.9, 40.0, 1)],
        "occupancy_rate double, calculated_occupancy double, available_rooms int",
    )
    got = [r.occupancy_rate for r in q.failing_rows(fact, suites.occupancy_agrees()).collect()]
    assert sorted(got) == [29.9, 50.1]


def test_required_columns_and_rows(df, rows):
    assert q.require_columns(df, ["id", "t"]) is df
    with pytest.raises(q.MissingColumns, match="x, y"):
        q.require_columns(df, ["id", "x", "y"])
    assert q.require_rows(df) is df
    with pytest.raises(ValueError):
        q.require_rows(rows([], "a int"))


def test_suites_cover_every_gold_table():
    assert set(suites.GOLD) == set(GRAIN)
    kinds = [c.kind for checks in (suites.SILVER | suites.GOLD).values() for c in checks]
    assert kinds.count("not_null") == 61
    assert kinds.count("unique") == 10
    assert kinds.count("accepted_values") == 10
    assert kinds.count("between") == 19
    assert sum(k.startswith("agrees_with") for k in kinds) == 1


def test_surrogate_keys_with_null_parts_are_compared_as_the_key_is(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None), (None, "a"), (None, "a"), (None, "a")], "id int, t string")
    repeated = {(r.id, r.t): r.num_rows for r in q.failing_rows(df, q.unique("key", ["id", "t"])).collect()}
    assert repeated == {(1, None): 2, (None, "a"): 3}
    assert {r.id for r in q.failing_rows(df, q.unique("id")).collect()} == {1}
