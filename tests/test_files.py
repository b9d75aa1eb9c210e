"""Sinks that replace files whole, files with headers of their own, rejected records, folds."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from codays.operators.clean import split_rejects
from codays.operators.counts import pair_counts
from codays.operators.folds import FIRST_DAY, LAST_DAY, N_DAYS, Fold, fold_pairs
from codays.operators.pairs import cooccurrences
from codays.sinks.files import overwrite_csv, overwrite_text, replace_folder
from codays.sources.csv_events import file_headers, load_event_files

from brute import rows


def contents(folder):
    return {p.name: p.read_bytes() for p in sorted(Path(folder).rglob("*")) if p.is_file()}


def test_a_failing_write_leaves_the_old_files_whole(spark, tmp_path):
    path = tmp_path / "out"
    overwrite_csv(spark.range(20).repartition(3), str(path))
    before = contents(path)
    failing = spark.range(20).select(F.when(F.col("id") == 19, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        overwrite_csv(failing, str(path))
    assert contents(path) == before
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_new_files_that_cannot_move_leave_the_old_ones(spark, tmp_path):
    path = tmp_path / "out"
    overwrite_text(spark.createDataFrame([("old",)], "value string"), str(path))
    before = contents(path)
    with pytest.raises(OSError, match="cannot take the place"):
        replace_folder(spark.range(1), str(path), lambda new: None)  # writes nothing
    assert contents(path) == before
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_a_table_can_be_replaced_by_what_is_read_from_it(spark, tmp_path):
    path = str(tmp_path / "out")
    overwrite_csv(spark.range(10), path)
    overwrite_csv(spark.read.schema("id long").option("header", True).csv(path).where("id > 6"), path)
    assert rows(spark.read.schema("id long").option("header", True).csv(path)) == [(7,), (8,), (9,)]


FILES = {
    "a.csv": "latitude,longitude,date\n1,2,2024-03-12\n,2,2024-03-12\nbad,2,2024-03-12\n1,2\n",
    "b.csv": '\n"x","longitude","date","latitude"\n,2,2024-03-13,9\n5,2,2024-03-13,9\n5,2,2024-03-13,9,more\n',
    "c.csv": "date,latitude,longitude\n,2,2024-03-14\n",
    "d.csv": "latitude,longitude,date\n3,4,2024-03-15\n" + "3,4,2024-03-15\n" * 30_000,
    "e.csv": "",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_headers_of_files(spark, folder):
    got = {Path(r.file).name: r.names for r in file_headers(spark, folder).collect()}
    assert got == {
        "a.csv": ["latitude", "longitude", "date"],
        "b.csv": ["x", "longitude", "date", "latitude"],
        "c.csv": ["date", "latitude", "longitude"],
        "d.csv": ["latitude", "longitude", "date"],
    }


def test_each_file_is_bound_by_its_own_header(spark, folder):
    loaded = load_event_files(spark, folder).withColumn("file", F.regexp_extract("file", "([^/]*)$", 1))
    assert loaded.columns == ["latitude", "longitude", "date", "file", "record"]
    got = [tuple(r) for r in loaded.where("file != 'd.csv'").collect()]
    assert sorted(got, key=str) == sorted(
        [
            ("1", "2", "2024-03-12", "a.csv", "1,2,2024-03-12"),
            (None, "2", "2024-03-12", "a.csv", ",2,2024-03-12"),
            ("bad", "2", "2024-03-12", "a.csv", "bad,2,2024-03-12"),
            ("1", "2", None, "a.csv", "1,2"),
            ("9", "2", "2024-03-13", "b.csv", ",2,2024-03-13,9"),
            ("5", "2", "2024-03-13", "b.csv", "5,2,2024-03-13,9"),
            ("5", "2", "2024-03-13", "b.csv", "5,2,2024-03-13,9,more"),
            ("2", "2", "2024-03-14", "c.csv", ",2,2024-03-14"),
        ],
        key=str,
    )
    assert loaded.where("file = 'd.csv'").count() == 30_001


def test_rejects_keep_their_record(spark, folder):
    split = split_rejects(load_event_files(spark, folder))
    named = split.rejects.select(F.regexp_extract("file", "([^/]*)$", 1), "record", "reason")
    assert rows(named) == [
        ("a.csv", ",2,2024-03-12", "latitude missing"),
        ("a.csv", "1,2", "date missing"),
        ("a.csv", "bad,2,2024-03-12", "latitude not a number"),
    ]
    assert split.events.count() == 30_001 + 5
    assert split.events.where("latitude is null or date is null").count() == 0


def test_no_files_with_rows(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("latitude,longitude,date\n")
    assert load_event_files(spark, str(tmp_path)).collect() == []


@pytest.fixture(scope="module")
def instances(spark):
    data = [(float(c), 0.0, f"20{20 + d // 12}-{d % 12 + 1:02d}-{(c * d) % 28 + 1:02d}") for c in range(6) for d in range(30)]
    data += [(1.0, 0.0, "odd"), (2.0, 0.0, "odd")]
    return cooccurrences(spark.createDataFrame(sorted(set(data)), "lat double, lon double, date string"), 2)


def test_folds_agree_with_aggregates(instances):
    pair = ["lat1", "lon1", "lat2", "lon2"]
    expected = instances.groupBy(*pair).agg(F.min("date"), F.max("date"), F.count("*"))
    assert rows(fold_pairs(instances, {"a": FIRST_DAY, "b": LAST_DAY, "n": N_DAYS})) == rows(expected)
    assert rows(fold_pairs(instances, {"n": N_DAYS})) == rows(pair_counts(instances, "reducebykey"))


def test_a_fold_of_ones_own(instances):
    """How many days were in a leap year, whatever the parts."""
    leap = Fold(lambda: F.lit(0), lambda n, date: n + date.startswith("2020").cast("int"), lambda n, m: n + m)
    expected = rows(instances.groupBy("lat1", "lon1", "lat2", "lon2").agg(F.count_if(F.col("date").startswith("2020"))))
    for part in (None, F.lit(0), F.xxhash64("date")):
        assert rows(fold_pairs(instances, {"n": leap}, part=part)) == expected
