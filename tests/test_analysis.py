from pathlib import Path
from types import SimpleNamespace

import pytest

from codays.plans.analysis import analyse, result_summary, result_text
from codays.session import release, shared_folder, staged, staging_path

TEXT = "((-12.3, 44.1), (5.6, -7.9))\n2021-07-02\n2021-08-15"


@pytest.fixture(scope="module")
def result(golden):
    return staged(analyse(golden), "golden")


@pytest.fixture(scope="module")
def nothing(golden):
    return staged(analyse(golden.where("date like '2021-09-2%'")), "nothing")


def test_golden(result):
    assert result.collect()[0].asDict() == {
        "lat1": -12.3,
        "lon1": 44.1,
        "lat2": 5.6,
        "lon2": -7.9,
        "max_count": 2,
        "n_dates": 2,
        "dates": ["2021-07-02", "2021-08-15"],
        "total_events": 10,
        "unique_events": 9,
        "co_occurrences": 5,
    }


def test_row_order_and_partitions_do_not_matter(golden, result):
    shuffled = golden.orderBy("date", ascending=False)
    assert analyse(shuffled, "2", 3).collect() == result.collect()


def test_no_winner(nothing):
    row = nothing.collect()[0]
    assert (row.lat1, row.max_count, row.n_dates, row.dates) == (None, 0, 0, [])
    assert (row.total_events, row.unique_events, row.co_occurrences) == (2, 2, 0)
    assert result_summary(nothing).count() == 0
    assert result_text(nothing).count() == 0


def test_no_valid_rows(spark, golden):
    rejected = spark.createDataFrame([("x", "y", "z")], golden.schema)
    row = analyse(rejected).first()
    assert (row.lat1, row.max_count, row.total_events) == (None, 0, 0)


def test_text(result):
    assert [r.value for r in result_text(result).collect()] == [TEXT]


@pytest.mark.parametrize("days, preview, more", [(10, 10, 0), (11, 5, 6)])
def test_summary_preview(golden, result, days, preview, more):
    from pyspark.sql import functions as F

    dates = [f"2024-01-{i + 1:02d}" for i in range(days)]
    made = result.withColumn("dates", F.array(*map(F.lit, dates))).withColumn("n_dates", F.lit(days))
    row = result_summary(made).first()
    assert (row.first_date, row.last_date) == (dates[0], dates[-1])
    assert row.preview == ", ".join(dates[:preview])
    assert row.more_dates == more


def test_staging_uses_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert shared_folder(spark) == folder
    assert staging_path(spark, "x").startswith(folder + "/codays/")
    assert staging_path(spark, "x") != staging_path(spark, "x")


def session_like(master, named=None, set_later=None):
    """Just the settings that ``shared_folder`` looks at."""
    context = SimpleNamespace(master=master, applicationId="a", getCheckpointDir=lambda: set_later)
    conf = SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": named}[key] or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_named_folder_comes_first():
    assert shared_folder(session_like("yarn", "hdfs:///work/", "hdfs:///other")) == "hdfs:///work"
    assert shared_folder(session_like("yarn", None, "hdfs:///other")) == "hdfs:///other"


def test_a_cluster_needs_a_named_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session_like("yarn"))


def test_release_removes_what_was_staged(spark):
    path = staging_path(spark, "kept")
    staged(spark.range(3), "gone")
    spark.range(3).write.parquet(path)
    checkpoints = spark.sparkContext.getCheckpointDir()
    release(spark)
    own = Path(staging_path(spark, "x").removeprefix("file:")).parent
    assert not own.exists() or not list(own.iterdir())
    assert spark.sparkContext.getCheckpointDir() == checkpoints
    assert staged(spark.range(3), "again").count() == 3
