import hashlib
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from estratos import fixed_values as fixed
from estratos import functions as fn

NBSP = " "


def column(spark, values, ddl, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r.x for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def python_title(text):
    words = (text or "").strip(fixed.SPACES).split(" ")
    return " ".join(w[:1].upper() + w[1:].lower() for w in words)


TITLES = {
    None: "",
    "   ": "",
    "bogotá D.C.": "Bogotá D.c.",
    "valle  del cauca": "Valle  Del Cauca",
    "ñandú": "Ñandú",
    f"{NBSP} SAN ANDRÉS {NBSP}": "San Andrés",
    "norte-de-santander": "Norte-de-santander",
    "5-LOW": "5-low",
}


def test_title_case(spark):
    assert column(spark, list(TITLES), "string", fn.title_case("v")) == list(TITLES.values())


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abcXYZáéíóúñÑÁ .-'0123  ", max_size=20), min_size=60, max_size=60))
def test_title_case_agrees_with_python(spark, texts):
    assert column(spark, texts, "string", fn.title_case("v")) == [python_title(t) for t in texts]


def test_trim_spaces(spark):
    values = [f"{c}a b{c}" for c in fixed.SPACES] + ["a\t", None, f"é{NBSP}", ""]
    assert column(spark, values, "string", fn.trim_spaces("v")) == ["a b"] * len(fixed.SPACES) + ["a\t", None, "é", ""]


def test_blank(spark):
    assert column(spark, [None, "", f" {NBSP}", "x"], "string", fn.blank("v")) == [True, True, True, False]


NUMBERS = ["2.7", "-2.7", "abc", "", None, " 12 ", "1,200", "NaN", "1e3", "1d", "0x10", ".5", "1e400", "3000000000", "inf"]


def test_lenient_int(spark):
    got = column(spark, NUMBERS, "string", fn.lenient_int("v", 7))
    assert got == [2, -2, 7, 7, 7, 12, 7, 7, 1000, 7, 7, 0, 7, 7, 7]


def test_lenient_double(spark):
    got = column(spark, NUMBERS[:12], "string", fn.lenient_double("v", 50.0))
    assert got == [2.7, -2.7, 50, 50, 50, 12, 50, 50, 1000, 50, 50, 0.5]
    assert column(spark, ["x"], "string", fn.lenient_double("v", None)) == [None]
    assert column(spark, [float("nan"), 1.5], "double", fn.lenient_double("v", 0.0, is_text=False)) == [0.0, 1.5]


def test_rounded_int_takes_halves_to_even(spark):
    assert column(spark, [2.5, 3.5, -2.5, 2.7, None], "double", fn.rounded_int("v")) == [2, 4, -2, 3, None]


def test_clamp(spark):
    values = [150.0, -10.0, 42.0, None]
    assert column(spark, values, "double", fn.clamp("v", 0, 100)) == [100, 0, 42, 0]
    assert column(spark, values, "double", fn.clamp("v", 0, 100, preserve_null=True)) == [100, 0, 42, None]


def test_guarded_pct(spark):
    df = spark.createDataFrame([(1, 3), (5, 0), (1, -2), (None, 4), (2, None)], "n int, d int")
    got = [r.x for r in df.select(fn.guarded_pct("n", "d").alias("x")).collect()]
    assert got == [33.3, 0.0, 0.0, None, 0.0]


def test_exact_sums_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, 0.25, 0.25] * 50
    for ordered in (values, sorted(values), sorted(values, reverse=True)):
        df = spark.createDataFrame([(v,) for v in ordered], "v double").repartition(7)
        total, mean = df.agg(fn.exact_sum("v", 2), fn.exact_avg("v", 2)).first()
        assert total == 50000000055.0
        assert mean == 50000000055.0 / 300


def test_settled_avg(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "v double")
    assert df.agg(fn.settled_avg("v")).first()[0] == 0.15


def test_periods(spark):
    df = spark.createDataFrame([(2024, 2), (2024, 13), (None, 1)], "y int, m int")
    got = df.select(
        fn.first_of_month("y", "m"), fn.mid_month("y", "m"), fn.period_text_date("y", "m")
    ).collect()
    assert [tuple(r) for r in got] == [
        (date(2024, 2, 1), date(2024, 2, 15), date(2024, 2, 1)), (None, None, None), (None, None, None),
    ]


def test_labels(spark):
    assert column(spark, [3], "int", fn.period_label(F.lit(2024), "v")) == ["2024-Q3"]
    months = list(range(0, 14))
    assert column(spark, months, "int", fn.month_short_name("v")) == [None, *fixed.MONTH_SHORT_NAMES, None]
    assert column(spark, months, "int", fn.month_name("v"))[9] == "Septiembre"
    assert column(spark, [0, 6], "int", fn.day_name("v")) == ["Domingo", "Sábado"]


def test_season_quarter(spark):
    got = column(spark, list(range(1, 13)), "int", fn.season_quarter("v"))
    assert got == ["Q1", "Q1", "Q2", "Q2", "Q2", "Q3", "Q3", "Q3", "Q4", "Q4", "Q4", "Q1"]


def test_parse_date(spark):
    values = ["2022-01-15", "2022-01-15 10:00:00", "15th of May", "", None]
    assert column(spark, values, "string", fn.parse_date("v")) == [date(2022, 1, 15), date(2022, 1, 15), None, None, None]


@pytest.mark.parametrize("parts", [(2024, 1, "Perú"), (None, 1, "x"), (2024, None, None)])
def test_surrogate_key(spark, parts):
    df = spark.createDataFrame([parts], "a int, b int, c string")
    text = "-".join(fixed.KEY_NULL if p is None else str(p) for p in parts)
    assert df.select(fn.surrogate_key("a", "b", "c")).first()[0] == hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2022-03-15", (2022, 3, 15)), ("2022-03-15 10:11:12", (2022, 3, 15)), ("15/03/2022", (2022, 3, 15)), ("03/04/2022", (2022, 3, 4)),
        ("2022/03/15", (2022, 3, 15)), ("20220315", (2022, 3, 15)), ("March 15, 2022", (2022, 3, 15)), (" 5 Mar 2022 ", (2022, 3, 5)),
        ("15.3.2022", (2022, 3, 15)), ("31/02/2022", None), ("sin fecha", None), ("", None), (None, None),
    ],
)
def test_date_texts(spark, text, day):
    got = spark.createDataFrame([(text,)], "t string").select(fn.parse_date("t").alias("d")).first().d
    assert got == (None if day is None else date(*day))


def test_formats_are_tried_on_texts_of_their_shape_only(spark):
    """A text that fits no format costs an exception in Spark; the shapes leave out no text that fits."""
    texts = [
        "20220415", "2022/4/5", "0004/05/2022", "15/04/2022", "04-15-2022", "15.4.2022", "APRIL 5, 2022", "Apr 15, 2022", "15 april 2022",
        "5-Apr-2022", "2022/4/5 7:08:09", "4/5/2022 23:59", "31/12/+12022", "30/02/2022", "13/13/2022", "4/5/2022 24:00", "s/f", "20221305", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(F.col("t").try_cast("date"), *[F.try_to_timestamp("t", F.lit(p)).cast("date") for p in fixed.DATE_FORMATS])
    made = df.select("t", fn.parse_date("t").cast("string").alias("got"), plain.cast("string").alias("want"))
    assert all(r.got == r.want for r in made.collect()) and made.where("got is not null").count() == 13
    plan = made.select("got")._jdf.queryExecution().optimizedPlan().toString()
    tried = [p for p in fixed.DATE_FORMATS if f", {p}," in plan]
    assert tried == fixed.DATE_FORMATS and plan.count("RLIKE") == len(tried), plan
