"""Data quality checks, on data that violates them."""

from __future__ import annotations

from pyspark.sql import functions as F

from estratos.operators import quality as q
from estratos.plans import bindings, suites
from registry import tables as t
from registry.base import register
from registry.oracles import sql


def _count(kind: str, column: str, table: str, fails: str) -> str:
    return (
        f"""select '{kind}' as "check", '{column}' as "column", 'warn' as severity, count(*) as n_failed """
        f"from {table} where {fails}"
    )


def _repeated(column: str, key: str, table: str) -> str:
    """Repeated values of the key column itself."""
    return (
        f"""select 'unique' as "check", '{column}' as "column", 'warn' as severity, count(*) as n_failed """
        f"from (select k from (select {key} as k from {table}) as s where k is not null group by k having count(*) > 1) as d"
    )


def _surrogate(*parts: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce(cast({part} as varchar), '_null_')" for part in parts) + ")"


# Line items with one column nulled where the flag is N, as the checked table.
_ITEMS = "(select *, nullif(l_returnflag, 'N') as flag, l_extendedprice - 50000 as margin from lineitem) as items"


def _items(spark, sf):
    return bindings.table(spark, sf, "lineitem").withColumns(
        {"flag": F.nullif(F.col("l_returnflag"), F.lit("N")), "margin": F.col("l_extendedprice") - 50000}
    )


@register(
    "check_not_null", "DQ1",
    f"select l_orderkey, l_linenumber, l_partkey, l_quantity from {_ITEMS} where flag is null",
)
def _check_not_null(spark, sf):
    rows = q.failing_rows(_items(spark, sf), q.not_null("flag"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@register(
    "check_unique", "DQ2",
    """select l_orderkey, l_linenumber, count(*) as num_rows from lineitem
       group by 1, 2 having count(*) > 1""",
)
def _check_unique(spark, sf):
    return q.failing_rows(bindings.table(spark, sf, "lineitem"), q.unique("line_id", ["l_orderkey", "l_linenumber"]))


@register(
    "check_accepted_values", "DQ3",
    "select o_orderkey, o_orderpriority from orders where o_orderpriority not in ('1-URGENT', '2-HIGH', '5-LOW')",
)
def _check_accepted_values(spark, sf):
    rows = q.failing_rows(
        bindings.table(spark, sf, "orders"), q.accepted_values("o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])
    )
    return rows.select("o_orderkey", "o_orderpriority")


@register(
    "check_between", "DQ4",
    "select o_orderkey, o_totalprice from orders where o_totalprice < 20000 or o_totalprice > 450000",
)
def _check_between(spark, sf):
    rows = q.failing_rows(bindings.table(spark, sf, "orders"), q.between("o_totalprice", 20000, 450000))
    return rows.select("o_orderkey", "o_totalprice")


@register(
    "check_positive_values", "DQ5",
    f"select l_orderkey, l_linenumber, l_partkey, margin from {_ITEMS} where margin < 0",
)
def _check_positive_values(spark, sf):
    rows = q.failing_rows(_items(spark, sf), q.not_negative("margin"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "margin")


@register(
    "check_occupancy_agrees", "DQ6",
    sql(
        """select * from fct_hotel_occupancy
           where abs(occupancy_rate - calculated_occupancy) > 10 and available_rooms > 0""",
        "fct_hotel_occupancy",
    ),
)
def _check_occupancy_agrees(spark, sf):
    return q.failing_rows(t.occupancy(spark, sf), suites.occupancy_agrees())


@register(
    "item_quality_report", "DQ1 DQ2 DQ3 DQ4 DQ5 DQ7",
    "\nunion all ".join([
        _count("not_null", "flag", _ITEMS, "flag is null"),
        _count("not_blank", "flag", _ITEMS, "trim(coalesce(flag, '')) = ''"),
        _count("accepted_values", "flag", _ITEMS, "flag not in ('A')"),
        _count("between", "l_quantity", _ITEMS, "l_quantity < 5 or l_quantity > 45"),
        _count("between", "l_tax", _ITEMS, "l_tax > 0.05"),
        _count("positive_values", "margin", _ITEMS, "margin < 0"),
        _count("not_above_l_tax", "l_discount", _ITEMS, "l_discount > l_tax"),
        _repeated("line_id", _surrogate("l_orderkey", "l_linenumber"), "lineitem"),
        _repeated("flag_id", _surrogate("l_partkey", "flag"), _ITEMS),
        _repeated("flag", "flag", _ITEMS),
    ]),
)
def _item_quality_report(spark, sf):
    """Seven row checks in one pass and three uniqueness checks, one on a key with null parts."""
    items = q.require_columns(_items(spark, sf), ["l_orderkey", "flag", "margin"])
    return q.report(
        items,
        [
            q.not_null("flag"),
            q.not_blank("flag"),
            q.accepted_values("flag", ["A"]),
            q.between("l_quantity", 5, 45),
            q.between("l_tax", high=0.05),
            q.not_negative("margin"),
            q.not_above("l_discount", "l_tax"),
            q.unique("line_id", ["l_orderkey", "l_linenumber"]),
            q.unique("flag_id", ["l_partkey", "flag"]),
            q.unique("flag"),
        ],
    )


@register(
    "gold_quality_report", "DQ1 DQ2 DQ3 DQ4 DQ6",
    sql(
        "select * from ("
        + "\nunion all ".join([
            "select 'fct_hotel_occupancy' as \"table\", * from ("
            + "\nunion all ".join([
                _repeated("occupancy_id", "occupancy_id", "fct_hotel_occupancy"),
                _count("not_null", "occupancy_id", "fct_hotel_occupancy", "occupancy_id is null"),
                _count("between", "occupancy_rate", "fct_hotel_occupancy",
                       "occupancy_rate < 0 or occupancy_rate > 100"),
                _count("agrees_with_calculated_occupancy", "occupancy_rate", "fct_hotel_occupancy",
                       "abs(occupancy_rate - calculated_occupancy) > 10 and available_rooms > 0"),
            ]) + ") as a",
            "select 'fct_tourism_balance' as \"table\", * from ("
            + "\nunion all ".join([
                _repeated("balance_id", "balance_id", "fct_tourism_balance"),
                _count("not_null", "balance_id", "fct_tourism_balance", "balance_id is null"),
                _count("not_null", "year", "fct_tourism_balance", "year is null"),
                _count("not_null", "quarter", "fct_tourism_balance", "quarter is null"),
                _count("not_null", "tourism_income_usd_millions", "fct_tourism_balance",
                       "tourism_income_usd_millions is null"),
                _count("accepted_values", "quarter", "fct_tourism_balance", "quarter not in (1, 2, 3, 4)"),
                _count("between", "tourism_income_usd_millions", "fct_tourism_balance",
                       "tourism_income_usd_millions < 0"),
            ]) + ") as b",
            "select 'dim_date' as \"table\", * from ("
            + "\nunion all ".join([
                _repeated("date_day", "date_day", "dim_date"),
                _count("not_null", "date_day", "dim_date", "date_day is null"),
                _count("not_null", "year", "dim_date", "year is null"),
                _count("not_null", "month", "dim_date", "month is null"),
                _count("not_null", "quarter", "dim_date", "quarter is null"),
                _count("between", "year", "dim_date", "year < 2019 or year > 2026"),
                _count("between", "month", "dim_date", "month < 1 or month > 12"),
                _count("accepted_values", "quarter", "dim_date", "quarter not in ('Q1', 'Q2', 'Q3', 'Q4')"),
            ]) + ") as c",
        ])
        + ") as r",
        "fct_hotel_occupancy", "fct_tourism_balance", "dim_date",
    ),
)
def _gold_quality_report(spark, sf):
    """Suites of three gold tables; the dates of the data lie outside the calendar's years on purpose."""
    names = ["fct_hotel_occupancy", "fct_tourism_balance", "dim_date"]
    return suites.quality_report({name: t.FACTS[name](spark, sf) for name in names}, suites.GOLD)
