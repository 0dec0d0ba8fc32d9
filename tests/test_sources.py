import csv
import io
import json
import random
import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from estratos.operators import sketches
from estratos.plans import bronze, reports
from estratos.schemas import BRONZE
from estratos.sources import readers, records, sinks


def put(path: Path, text: str, encoding: str = "utf-8") -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_plain_csv(spark, tmp_path):
    path = put(tmp_path / "plain.csv", "anio,mes,valor\n2022,1,100\n2022,2,200\n")
    df = readers.read_csv(spark, path)
    assert dict(df.dtypes) == {"anio": "string", "mes": "string", "valor": "string"}
    assert df.agg(F.sum(F.col("valor").cast("int"))).first()[0] == 300


def test_files_are_matched_by_header_not_position(spark, tmp_path):
    put(tmp_path / "arrivals_1.csv", "year,month,pais\n2020,1,A\n")
    put(tmp_path / "arrivals_2.csv", "pais,month,year,extra\nB,2,2021,x\n")
    put(tmp_path / "sub_llegadas.csv", "month,year,pais\n3,2022,C\n")
    put(tmp_path / "other.csv", "year\n1999\n")
    df = readers.read_csv_by_name(spark, [f"{tmp_path}/*arrivals*", f"{tmp_path}/*llegadas*", f"{tmp_path}/*none*"])
    got = sorted((r.year, r.month, r.pais, r.extra) for r in df.collect())
    assert got == [("2020", "1", "A", None), ("2021", "2", "B", "x"), ("2022", "3", "C", None)]


def test_a_file_matched_twice_is_read_once(spark, tmp_path):
    put(tmp_path / "arrivals_llegadas.csv", "year\n2020\n")
    df = readers.read_csv_by_name(spark, [f"{tmp_path}/*arrivals*", f"{tmp_path}/*llegadas*"])
    assert df.count() == 1


def test_no_matching_file(spark, tmp_path):
    assert readers.read_csv_by_name(spark, [f"{tmp_path}/*arrivals*"]) is None


def test_character_sets(spark, tmp_path):
    path = put(tmp_path / "l1.csv", "año,país\n2020,Perú\n", "latin-1")
    df = readers.read_csv(spark, path, encoding="ISO-8859-1")
    assert df.columns == ["año", "país"] and df.first()[1] == "Perú"


def test_undecodable_bytes_are_replaced(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_bytes(b"a,b\nPer\xfa,1\nok,2\n")
    got = readers.read_csv(spark, str(path)).collect()
    assert [r.b for r in got] == ["1", "2"] and got[0].a.startswith("Per") and "�" in got[0].a


def test_quotes_and_missing_words(spark, tmp_path):
    path = put(tmp_path / "q.csv", 'a,b\n"x, ""y""",N/A\n,NULL\n null ,0\n')
    got = [tuple(r) for r in readers.read_csv(spark, path).collect()]
    assert got == [('x, "y"', None), (None, None), (" null ", "0")]


def test_line_breaks_in_cells(spark, tmp_path):
    path = put(tmp_path / "m.csv", 'a,b\n"x\ny",1\n')
    assert readers.read_csv(spark, path, multiline=True).first().a == "x\ny"


@pytest.fixture
def tiny_blocks(spark):
    """Files are split into blocks of some hundred bytes, so cells and quotes lie across them."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "400")
    spark.conf.set(names[1], "1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_cells_over_many_blocks(spark, tmp_path, tiny_blocks):
    """Random cells of quotes, commas and breaks, some longer than a block, against Python's own reader; two headers."""
    rng, want = random.Random(4), []
    for k in range(3):
        cells = lambda n: "".join(rng.choice(["a", " ", '"', ",", "\n", "\r\n", "xyz", "é"]) for _ in range(rng.randrange(n)))  # noqa: B023, E731
        rows = [[cells(9) if rng.random() < 0.3 else "plain", cells(9) if i != 20 else cells(900) + ".", f"{k}-{i}"] for i in range(40)]
        names = ["a", "b\nreak" if k == 2 else "b", "c"]
        text = io.StringIO(newline="")
        csv.writer(text, lineterminator="\n").writerows([names, *rows])
        (tmp_path / f"{k}.csv").write_bytes(text.getvalue().encode())
        want += [(k == 2, *row) for row in rows]
    got = readers.read_csv_by_name(spark, [f"{tmp_path}/*.csv"])
    # A carriage return before a line feed inside a cell is part of the line end, an empty cell is null.
    clean = lambda c: re.sub("\r+\n", "\n", c).rstrip("\r") or None
    own = [(r["b\nreak"] is not None, r.a, r.b if r.b is not None else r["b\nreak"], r.c) for r in got.collect()]
    assert sorted(map(str, [(*(x and clean(x) for x in r[1:]),) for r in own])) == sorted(map(str, [tuple(map(clean, r[1:])) for r in want]))
    assert got.columns == ["a", "b", "c", "b\nreak"]


def test_only_files_with_breaks_are_read_by_their_records(spark, tmp_path):
    put(tmp_path / "in/a.csv", 'a,b\n1,"x"\n2,y\n')
    put(tmp_path / "in/b.csv", 'a,b\r\n3,"x\r\ny"\r\n\r\n4,"z, ""q"""\r\n')
    put(tmp_path / "in/c.csv", "")
    found = readers.surveyed(spark, readers.list_files(spark, [f"{tmp_path}/in"]), "UTF-8", True)
    assert {path.rpartition("/")[2]: f for path, f in found.items()} == {"a.csv": ("a,b", False), "b.csv": ("a,b", True)}
    got = readers.read_csv(spark, f"{tmp_path}/in", flag_broken=True)
    assert sorted(map(tuple, got.collect())) == [("1", "x", False), ("2", "y", False), ("3", "x\ny", False), ("4", 'z, "q"', False)]


def test_line_breaks_in_other_character_sets(spark, tmp_path):
    (tmp_path / "l1.csv").write_bytes('año,país\n2020,"Perú\nñ"\n'.encode("latin-1"))
    (tmp_path / "u16.csv").write_bytes('año,país\n2020,"Perú\nñ"\n'.encode("utf-16"))
    for name, encoding in (("l1", "ISO-8859-1"), ("u16", "UTF-16")):
        df = readers.read_csv(spark, f"{tmp_path}/{name}.csv", encoding=encoding)
        assert df.columns == ["año", "país"] and tuple(df.first()) == ("2020", "Perú\nñ")


def answer(indicator, country, values):
    records = [
        {"indicator": {"id": indicator, "value": "a long name"}, "country": {"id": country, "value": "Somewhere"}, "date": str(year), "value": value}
        for year, value in values.items()
    ]
    return json.dumps([{"page": 1}, records])


TWO = answer("QQ.A", "ZZ", {2031: 17.5, 2032: 0.25, 2033: None})


def test_indicator_answers(spark, tmp_path):
    put(tmp_path / "a.json", TWO)
    for i, text in enumerate(["[{}, null]", "[{}]", "{}", "junk", "[]", '[{}, {"a": 1}]', "[{}, []]"]):
        put(tmp_path / f"b{i}.json", text)
    got = readers.read_indicator_files(spark, f"{tmp_path}/*.json").orderBy("year").collect()
    assert [(r.year, r.value, r.indicator_code, r.country_name, r.source) for r in got] == [
        (2031, 17.5, "QQ.A", "Somewhere", "world_bank"), (2032, 0.25, "QQ.A", "Somewhere", "world_bank"),
    ]


@pytest.mark.parametrize("name", ["PER_ST.INT.ARVL.json", "country_code=PER/indicator_code=ST.INT.ARVL/part-0.txt"])
def test_what_was_asked_for_is_in_the_path(spark, tmp_path, name):
    path = put(tmp_path / name, answer("st", "PE", {2031: 5.0}))
    (row,) = readers.read_indicator_files(spark, path).collect()
    assert (row.country_code, row.country_name, row.indicator_code, row.indicator_name) == (
        "PER", "Perú", "ST.INT.ARVL", "international_arrivals",
    )


def test_asked_codes_can_replace_the_records_own(spark, rows):
    df = rows([(TWO, "COL")], "payload string, asked string")
    got = readers.parse_indicator_payloads(df, country_code="asked").collect()
    assert {r.country_code for r in got} == {"COL"}


def test_seed_codes_stay_text(spark, tmp_path):
    path = put(tmp_path / "seed.csv", "dane_code,department,capital,region\n05,Antioquia,Medellín,Andina\n")
    assert tuple(readers.read_seed(spark, path).first()) == ("05", "Antioquia", "Medellín", "Andina")


def test_seed_columns_are_found_by_header(spark, tmp_path):
    path = put(tmp_path / "seed.csv", "department,nota,region,dane_code,capital\nChocó,x,Pacífica,07,Quibdó\n")
    assert tuple(readers.read_seed(spark, path).first()) == ("07", "Chocó", "Quibdó", "Pacífica")


def test_headers_of_many_files_take_one_job(spark, tmp_path):
    for i in range(30):
        put(tmp_path / f"a b{i}+é.csv", ["x,y\n1,2\n", "y,x\r\n2,1\r\n", ""][i % 3])
    files = readers.list_files(spark, [f"{tmp_path}/*.csv"])
    tracker, group = spark.sparkContext.statusTracker(), "headers"
    spark.sparkContext.setJobGroup(group, group)
    groups = readers.files_by_header(spark, files)
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {h: len(p) for h, p in groups.items()} == {"x,y": 10, "y,x": 10} and jobs <= 6
    got = readers.read_csv_by_name(spark, [f"{tmp_path}/*.csv"])
    assert {tuple(r) for r in got.select("x", "y").collect()} == {("1", "2")} and got.count() == 20


def test_lines_of_a_broken_row_are_flagged(spark, tmp_path):
    path = put(tmp_path / "m.csv", 'a,b,c\n1,"x\ny",2\n3,"p ""q""",4\n5,short\n')
    rows = readers.read_csv(spark, path, multiline=False, flag_broken=True).collect()
    assert [(r.a, r[readers.BROKEN]) for r in rows] == [("1", True), ('y"', True), ("3", False), ("5", False)]
    assert readers.read_csv(spark, path, multiline=False, flag_broken=True).where(readers.BROKEN).count() == 2
    assert [tuple(r) for r in readers.read_csv(spark, path).orderBy("a").collect()] == [("1", "x\ny", "2"), ("3", 'p "q"', "4"), ("5", "short", None)]


def test_unreadable_files_lead_to_the_fallback_and_other_failures_do_not(spark, rows, tmp_path):
    full = rows([("1", "2")], "a string, b string")
    put(tmp_path / "two/x.csv", "a,b\n1,2\n")
    put(tmp_path / "two/y.csv", "b,a\n2,1\n")
    put(tmp_path / "no.parquet", "text")

    def two():
        return spark.read.schema("b string, a string").options(**readers.csv_options()).csv(f"{tmp_path}/two/x.csv")

    def damaged():
        return spark.read.schema("a string").parquet(f"{tmp_path}/no.parquet")

    for primary in (two, damaged):
        assert readers.read_or_else(primary, lambda: full, "p", "f").first().source_used == "f"

    def failing():
        return full.select(F.raise_error(F.lit("a task failed")).alias("a"))

    with pytest.raises(Exception, match="a task failed"):
        readers.read_or_else(failing, lambda: full, "p", "f").collect()


def test_an_archive_that_cannot_be_written_raises(spark, rows, tmp_path):
    put(tmp_path / "in.csv", "year,month,llegadas\n2020,1,5\n")
    put(tmp_path / "archive", "a file, not a folder")
    fallback = rows([(2021, 1)], "year int, month int")
    with pytest.raises(Exception, match="(?i)parent|director|exists|mkdirs|create"):
        bronze.load(spark, "arrivals", f"{tmp_path}/in.csv", fallback, f"{tmp_path}/out", archive=f"{tmp_path}/archive")


def test_a_file_that_fails_during_the_load_leads_to_the_fallback(spark, rows, tmp_path):
    put(tmp_path / "in/a.csv", "year,month,llegadas\n" + "2020,1,5\n" * 50)
    put(tmp_path / "in/b.csv", "llegadas,year\n1,2\n" * 50)
    fallback = rows([(2021, 1)], "year int, month int")
    report = bronze.load(spark, "arrivals", f"{tmp_path}/in", fallback, f"{tmp_path}/out", multiline=True)
    assert report.source_used in ("landed", "fallback")
    strict = spark.read.schema("year string, month string, llegadas string").options(**readers.csv_options())
    assert readers.read_or_else(lambda: strict.csv(f"{tmp_path}/in/b.csv"), lambda: fallback, "p", "f").first().source_used == "f"


def test_loads_are_summed_up_without_their_rows(spark, rows, tmp_path):
    put(tmp_path / "a.csv", "year,month,pais,llegadas\n2020,1,Chile,5\n2021,2,,6\n2020,3,Perú,7\n")
    put(tmp_path / "b.csv", "year,month,pais,llegadas\n2019,1,Chile,5\n2019,2,Cuba,6\n")
    fallback, kept = rows([], BRONZE["arrivals"]), f"{tmp_path}/kept"
    first = bronze.load(spark, "arrivals", f"{tmp_path}/a.csv", fallback, f"{tmp_path}/out-a", sketches=kept)
    exact = bronze.load(spark, "arrivals", f"{tmp_path}/a.csv", fallback, f"{tmp_path}/out-c")
    assert (first.distinct, first.latest, first.preview) == (exact.distinct, exact.latest, exact.preview)
    assert first.latest["year"] == 2021 and set(first.latest) == set(BRONZE["arrivals"].names)
    bronze.load(spark, "arrivals", f"{tmp_path}/b.csv", fallback, f"{tmp_path}/out-b", sketches=kept)
    bronze.load(spark, "arrivals", f"{tmp_path}/b.csv", fallback, f"{tmp_path}/out-b", sketches=kept)  # replaces its summary
    whole = bronze.summary_of_loads(spark, "arrivals", kept).first()
    seen = {r.country_of_origin for x in "ab" for r in spark.read.parquet(f"{tmp_path}/out-{x}").collect()} - {None}
    assert (whole.num_rows, whole.year_min, whole.year_max, whole.country_of_origin_count) == (5, 2019, 2021, len(seen))
    nothing = bronze.load(spark, "arrivals", None, fallback, f"{tmp_path}/out-d", sketches=f"{tmp_path}/other")
    assert (nothing.num_rows, nothing.latest, set(nothing.distinct.values())) == (0, None, {0})


def test_sketches_unite_as_if_made_at_once(spark, rows):
    df = rows([(2000 + i % 7, i % 3, f"k{i * i % 700}" if i % 5 else None) for i in range(3000)], "year int, load int, k string")
    parts = sketches.summarised(df, ["k"], ["load"])
    united, want = sketches.united(parts, ["k"]).first(), df.select("k").dropna().distinct().count()
    assert (parts.count(), united.num_rows, united.year_min, united.year_max) == (3, 3000, 2000, 2006)
    assert abs(united.k_count - want) <= 0.05 * want
    assert tuple(sketches.united(parts.limit(0), ["k"]).first()) == (0, None, None, 0)


def test_a_load_counts_what_it_could_not_read(spark, rows, tmp_path):
    lines = ["fecha_llegada,pais,llegadas", "15/03/2022,Chile,5", "sin fecha,Chile,6", '2022-04-01,"Costa', 'Rica",7', "2022-05-01,Perú,8"]
    put(tmp_path / "in.csv", "\n".join(lines) + "\n")
    fallback = rows([], BRONZE["arrivals"])
    report = bronze.load(spark, "arrivals", f"{tmp_path}/in.csv", fallback, f"{tmp_path}/out", multiline=False)
    assert (report.source_used, report.num_rows, report.rows_broken, report.dates_unreadable) == ("landed", 2, 2, 1)
    assert report.distinct == {"country_of_origin_count": 2, "destination_department_count": 1}
    assert report.latest["country_of_origin"] == "Perú" and len(report.preview) == 2
    whole = bronze.load(spark, "arrivals", f"{tmp_path}/in.csv", fallback, f"{tmp_path}/out", multiline=True)
    assert (whole.num_rows, whole.rows_broken, whole.dates_unreadable) == (3, 0, 1)


def test_source_choice(spark, rows, tmp_path):
    full, empty = rows([(1,)], "x int"), rows([], "x int")

    def used(primary):
        return [r.source_used for r in readers.read_or_else(primary, lambda: full, "p", "f").collect()]

    assert used(lambda: full) == ["p"]
    assert used(lambda: empty) == ["f"]
    assert used(None) == ["f"]
    assert used(lambda: None) == ["f"]
    assert used(lambda: readers.read_csv(spark, f"{tmp_path}/missing.csv")) == ["f"]


def test_a_programming_error_is_not_taken_for_a_missing_source(rows):
    with pytest.raises(ZeroDivisionError):
        readers.read_or_else(lambda: 1 // 0, lambda: rows([(1,)], "x int"))


def test_parquet_round_trip_with_metrics(spark, rows, tmp_path):
    df = rows([(1, "a"), (2, "b"), (3, "c")], "id int, valor string")
    assert sinks.write_parquet(df, f"{tmp_path}/t") == {"num_rows": 3}
    assert sorted(tuple(r) for r in readers.read_table(spark, f"{tmp_path}/t", df.schema).collect()) == [
        (1, "a"), (2, "b"), (3, "c"),
    ]


def test_partitioned_write_skips_folders_when_read(spark, rows, tmp_path):
    df = rows([(y, v) for y in (2019, 2020, 2021) for v in range(5)], "year int, v int")
    assert sinks.write_parquet(df, f"{tmp_path}/t", ["year"]) == {"num_rows": 15, "year_min": 2019, "year_max": 2021}
    read = readers.read_table(spark, f"{tmp_path}/t", df.schema).where(F.col("year") == 2020)
    assert read.count() == 5 and len(read.inputFiles()) >= 1
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_table_and_export(spark, rows, tmp_path):
    df = rows([(1,), (2,)], "x int")
    assert sinks.save_as_table(df, "estratos_test_table", f"{tmp_path}/table") == 2
    assert sinks.save_as_table(df.union(df), "estratos_test_table", f"{tmp_path}/table") == 4
    sinks.export_table(spark, "estratos_test_table", f"{tmp_path}/export")
    assert spark.read.parquet(f"{tmp_path}/export").count() == 4
    spark.sql("drop table estratos_test_table")


def test_csv_export_keeps_order_and_text(spark, rows, tmp_path):
    df = rows([(i, f' "{i}", é\t') for i in range(500)], "k int, t string").repartition(9)
    sinks.export_csv(df.orderBy("k"), f"{tmp_path}/csv")
    files = sorted(Path(f"{tmp_path}/csv").glob("part-*.csv"))
    lines = [line for f in files for line in f.read_text("utf-8").splitlines()[1:]]
    assert [int(line.split(",")[0]) for line in lines] == list(range(500))
    back = readers.read_csv(spark, f"{tmp_path}/csv").where("k = '7'").first()
    assert back.t == ' "7", é\t'


def test_sorted_write_splits_a_frequent_key(spark, tmp_path):
    df = spark.range(20000).select(
        F.when(F.col("id") < 15000, 5).otherwise(F.col("id") % 10).cast("int").alias("k"), "id"
    )
    sinks.write_sorted(df, f"{tmp_path}/s", ["k"])
    files = sorted(Path(f"{tmp_path}/s").glob("part-*.parquet"))
    keys = [[r.k for r in spark.read.parquet(str(f)).collect()] for f in files]
    assert [k for part in keys for k in part] == sorted(k for part in keys for k in part)
    assert sum(len(part) for part in keys) == 20000


def test_archives(spark, tmp_path):
    data = b"a,b\r\n1,Per\xfa\r\nlast"
    (tmp_path / "in.csv").write_bytes(data)
    sinks.archive_payloads(spark, f"{tmp_path}/in.csv", f"{tmp_path}/raw", "x", date(2024, 5, 1))
    kept = spark.read.parquet(f"{tmp_path}/raw/x/ingest_date=2024-05-01").first()
    assert bytes(kept.content) == data and kept.length == len(data) and kept.path.endswith("in.csv")
    sinks.archive_lines(spark, f"{tmp_path}/in.csv", f"{tmp_path}/raw", "y", date(2024, 5, 1))
    lines = spark.read.parquet(f"{tmp_path}/raw/y/ingest_date=2024-05-01")
    got = [bytes(r[0]) for r in lines.select(F.col("value").cast("binary")).collect()]
    assert got == [b"a,b\r", b"1,Per\xfa\r", b"last"]


def test_every_export_order_ends_in_a_key():
    for table, order in reports.EXPORT_ORDER.items():
        assert order[-1].endswith("_id") or order[-1] == "dane_code", table


def test_canonical_schemas_have_no_nested_columns():
    assert all(f.dataType.typeName() in {"integer", "long", "double", "string", "date"} for s in BRONZE.values() for f in s)


def test_records_with_breaks_are_joined_where_they_are_read(spark, tmp_path, monkeypatch):
    """Only lines at the edges of a block are written again, sorted or sent to other tasks."""
    text = "a,b,c\n" + "".join(f'"x{i}\n\ny","p ""q"",\nr",{i}\n' for i in range(500)) + '"never closed,1\n7,8,9\n'
    path = put(tmp_path / "in/r.csv", text)
    monkeypatch.setattr(readers, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        rows = sorted(map(tuple, readers.read_csv(spark, path, flag_broken=True).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = [(f"x{i}\n\ny", 'p "q",\nr', str(i), False) for i in range(500)] + [("never closed,1", None, None, True), ("7", "8", "9", False)]
    assert rows == sorted(want, key=str)
    assert spark.read.parquet(f"{tmp_path}/csv-blocks/placed").count() < 100


def test_a_record_is_parsed_once(spark, rows):
    found = rows([("f", "1,x", False, False), ("f", "NULL,y", False, False)], "path string, record string, header boolean, broken boolean")
    df = readers.record_rows(found, ["a", "b"], True)
    assert sorted(map(tuple, df.collect()), key=str) == [("1", "x", False), (None, "y", False)]
    plan = df.where("a > 0 and b <> ''")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("from_csv(") + plan.lower().count("csvtostructs(") == 1, plan


def test_the_survey_does_not_sort_the_lines(spark, tmp_path, monkeypatch):
    path = put(tmp_path / "s.csv", "\n \nh1,h2\r\n" + '1,"x\ny"\n' * 50)
    seen = []
    heads = records.block_heads
    monkeypatch.setattr(records, "block_heads", lambda lines: seen.append(heads(lines)) or seen[-1])
    assert list(readers.surveyed(spark, [path], "UTF-8", True).values()) == [("h1,h2", True)]
    assert seen[0].count() == 1


def test_the_survey_hands_on_no_line_that_tells_nothing(spark, tmp_path, monkeypatch, tiny_blocks):
    """Of blocks after the first only lines that leave a cell open go to Python."""
    path = put(tmp_path / "s.csv", "h1,h2\n" + '1,"x"\n' * 500)
    seen = []
    heads = records.block_heads
    monkeypatch.setattr(records, "block_heads", lambda lines: seen.append(lines) or heads(lines))
    assert list(readers.surveyed(spark, [path], "UTF-8", True).values()) == [("h1,h2", False)]
    assert {r.block for r in seen[0].select("block").distinct().collect()} == {0}
