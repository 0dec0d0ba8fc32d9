import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estratos.plans import bronze, silver
from estratos.schemas import BRONZE
from estratos.streaming import landing


class Drop:
    """A landing folder with its sink and checkpoint."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        (root / "in").mkdir()

    def put(self, name, *lines, header="year,month,llegadas"):
        (self.root / "in" / name).write_text("\n".join([header, *lines]) + "\n", "utf-8")

    def run(self, folder="in", **options):
        return landing.load_new_files(
            self.spark, f"{self.root}/{folder}", ["year", "month", "llegadas"],
            lambda rows: bronze.arrivals_csv(rows), f"{self.root}/out", f"{self.root}/check", **options,
        )

    def rows(self):
        return landing.loaded_rows(self.spark, f"{self.root}/out", BRONZE["arrivals"])


@pytest.fixture
def drop(spark, tmp_path):
    return Drop(spark, tmp_path)


def test_each_file_is_loaded_once(drop):
    drop.put("arrivals_2023.csv", "2023,1,5", "2023,13,9")
    assert drop.run() == 2
    assert drop.run() == 0
    drop.put("arrivals_2024.csv", "2024,1,7")
    drop.put("llegadas_2025.csv", "2025,2,abc")
    drop.put("notes.txt", "x")
    assert drop.run() == 2
    assert drop.run() == 0
    got = sorted((r.year, r.month, r.number_of_visitors, r.travel_purpose) for r in drop.rows().collect())
    assert got == [(2023, 1, 5, "Turismo"), (2024, 1, 7, "Turismo"), (2025, 2, 0, "Turismo")]


def test_names_with_commas_are_no_problem(drop):
    drop.put("a,b.csv", "2020,1,1")
    assert drop.run() == 1 and drop.run() == 0


def test_empty_folder(drop):
    assert drop.run() == 0


def test_missing_folder_is_logged_and_skipped(drop, caplog):
    assert drop.run(folder="nothing") == 0
    assert "cannot list" in caplog.text


def test_another_header_fails_instead_of_shifting_values(drop):
    drop.put("x.csv", "5,2020,1", header="llegadas,year,month")
    with pytest.raises(StreamingQueryException):
        drop.run()


def test_partitioned_sink_and_cleaning_agree_with_batch(spark, drop):
    drop.put("x.csv", *[f"{2010 + i % 9},{i % 14},{i}" for i in range(300)])
    drop.run(partition_by=["year"])
    batch = bronze.arrivals_csv(spark.read.option("header", True).csv(f"{drop.root}/in"))
    columns = drop.rows().columns
    assert drop.rows().exceptAll(batch.select(columns)).isEmpty()
    assert drop.rows().count() == batch.count()
    assert silver.stg_tourism_arrivals(drop.rows()).where(F.col("year") < 2015).isEmpty()


def test_rows_of_many_files_are_one_run(spark, drop):
    for year in (2020, 2021, 2022, 2023):
        drop.put(f"{year}.csv", f"{year},1,1", f"{year},2,1")
    assert drop.run() == 8 and drop.rows().count() == 8
    assert [(r.run, r.rows_read, r.rows_kept) for r in landing.published(spark, f"{drop.root}/out")] == [(0, 8, 8)]


def test_whole_columns_are_judged_over_all_files_of_a_run(spark, tmp_path):
    (tmp_path / "in").mkdir()
    header = "year,month,llegadas,fecha_llegada"
    (tmp_path / "in" / "a.csv").write_text(f"{header}\n2020,1,5,\n")
    (tmp_path / "in" / "b.csv").write_text(f"{header}\n2020,2,5,2020-02-03\n")

    def run():
        return landing.load_new_files(
            spark, f"{tmp_path}/in", header.split(","), lambda rows: bronze.arrivals_csv(rows), f"{tmp_path}/out", f"{tmp_path}/check"
        )

    def dates():
        rows = landing.loaded_rows(spark, f"{tmp_path}/out", BRONZE["arrivals"]).collect()
        return sorted((r.month, str(r.arrival_date)[:10]) for r in rows)

    assert run() == 2 and dates() == [(1, "None"), (2, "2020-02-03")]
    (tmp_path / "in" / "c.csv").write_text(f"{header}\n2020,3,5,\n")
    assert run() == 1 and dates()[2] == (3, "2020-03-15")
    assert run() == 0 and len(dates()) == 3


def test_a_run_that_broke_off_is_repeated_and_adds_nothing_twice(spark, drop):
    drop.put("x.csv", "2020,1,1")
    fail = [True]

    def transform(rows):
        if fail:
            raise RuntimeError(fail.pop())
        return bronze.arrivals_csv(rows)

    def run():
        return landing.load_new_files(
            spark, f"{drop.root}/in", ["year", "month", "llegadas"], transform, f"{drop.root}/out", f"{drop.root}/check"
        )

    with pytest.raises(StreamingQueryException):
        run()
    assert run() == 1 and run() == 0 and drop.rows().count() == 1


def test_line_breaks_in_cells(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('year,month,pais\n2020,1,"Estados\nUnidos"\n')
    landing.load_new_files(
        spark, f"{tmp_path}/in", ["year", "month", "pais"], lambda rows: bronze.arrivals_csv(rows),
        f"{tmp_path}/out", f"{tmp_path}/check",
    )
    (row,) = landing.loaded_rows(spark, f"{tmp_path}/out", BRONZE["arrivals"]).collect()
    assert row.country_of_origin == "Estados\nUnidos"


def test_a_query_can_be_started_on_its_own(spark, tmp_path):
    drop = Drop(spark, tmp_path)
    for year in (2020, 2021, 2022):
        drop.put(f"{year}.csv", f"{year},1,1")
    rows = landing.landed_rows(spark, f"{tmp_path}/in", ["year", "month", "llegadas"])
    landing.ingest(rows, lambda r: r.select("year"), f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    years = landing.loaded_rows(spark, f"{tmp_path}/out", T.StructType([T.StructField("year", T.StringType())]))
    assert sorted(r.year for r in years.collect()) == ["2020", "2021", "2022"]


def test_readers_see_a_run_whole_or_not_at_all(spark, drop, monkeypatch):
    """A run that dies between its files and its manifest entry leaves readers with what was there before."""
    drop.put("a.csv", "2020,1,1")
    assert drop.run(partition_by=["year"]) == 1
    before = drop.rows().collect()
    drop.put("b.csv", "2021,1,1", "2021,2,1")
    real = landing.publish

    def dies(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(landing, "publish", dies)
    with pytest.raises(StreamingQueryException, match="killed"):
        drop.run(partition_by=["year"])
    left = [p for p in (drop.root / "out").rglob("*.parquet") if "run=1" in str(p)]
    assert left and drop.rows().collect() == before
    monkeypatch.setattr(landing, "publish", real)
    assert drop.run(partition_by=["year"]) == 2 and drop.rows().count() == 3
    assert drop.run(partition_by=["year"]) == 0 and drop.rows().count() == 3


def test_a_run_published_before_its_checkpoint_is_not_written_again(spark, drop, monkeypatch):
    drop.put("a.csv", "2020,1,1")
    real, calls = landing.publish, []

    def dies_after(*args):
        real(*args)
        calls.append(args)
        raise RuntimeError("killed")

    monkeypatch.setattr(landing, "publish", dies_after)
    with pytest.raises(StreamingQueryException):
        drop.run()
    assert drop.rows().count() == 1
    assert drop.run() == 1 and drop.rows().count() == 1 and len(calls) == 1


def test_batch_and_stream_read_broken_lines_alike(spark, tmp_path):
    """Cells of three lines, first, middle and last, blank lines in cells, and a quote that is never closed."""
    text = (
        'pais,year,month,entrada,llegadas\n"A\n\nB",2020,1,x,1\nC,2020,2,"one\ntwo\nthree",2\n\nD,2020,3,x,"4\n\n"\n'
        '5" pipe,2020,4,y,5\n"never closed,2020,5,z,6\nE,2020,6,z,7\n'
    )
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "arrivals.csv").write_text(text)
    (tmp_path / "in" / "arrivals2.csv").write_text("pais,year,month,entrada,llegadas\nF,2021,1,x,1\n")
    columns = "pais,year,month,entrada,llegadas".split(",")
    landing.load_new_files(spark, f"{tmp_path}/in", columns, bronze.arrivals_csv, f"{tmp_path}/out", f"{tmp_path}/check")
    stream = landing.loaded_rows(spark, f"{tmp_path}/out", BRONZE["arrivals"])
    report = bronze.load(spark, "arrivals", f"{tmp_path}/in", stream.limit(0), f"{tmp_path}/batch")
    batch = spark.read.schema(BRONZE["arrivals"]).parquet(f"{tmp_path}/batch")
    got = sorted((r.country_of_origin, r.year, r.month, r.number_of_visitors) for r in stream.collect())
    assert [g[0] for g in got] == ['5" pipe', "A\n\nB", "C", "D", "E", "F"] and report.rows_broken == 1
    assert sorted(map(str, batch.collect())) == sorted(map(str, stream.collect()))
    dropped = bronze.arrivals_files(spark, f"{tmp_path}/in")
    assert sorted(r.country_of_origin for r in dropped.collect()) == [g[0] for g in got]
