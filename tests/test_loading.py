"""Counts observed at load, the number of jobs, and day bitmaps."""

from contextlib import contextmanager

import pytest

from codays.operators.contenders import day_bitmaps
from codays.operators.grid import cell_days, row_counts, with_day_sizes
from codays.plans.analysis import analyse, load
from codays.session import staged
from codays.sources.seismic import seismic_table

from brute import rows


@contextmanager
def settings(spark, **values):
    names = {name: f"spark.sql.{name.replace('_', '.')}" for name in values}
    before = {name: spark.conf.get(names[name]) for name in values}
    for name, value in values.items():
        spark.conf.set(names[name], value)
    yield
    for name, value in before.items():
        spark.conf.set(names[name], value)


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_counts_come_with_the_one_job_that_writes(spark, golden):
    dirty = spark.createDataFrame([("x", "1", "2024-03-12"), (None, "1", "2024-03-12")], golden.schema)
    raw = staged(golden.union(dirty), "raw")
    loaded = []
    with settings(spark, adaptive_enabled="false", autoBroadcastJoinThreshold="-1"):
        assert jobs_of(spark, "load", lambda: loaded.append(load(raw))) == 1
    assert tuple(loaded[0].counts.values()) == tuple(row_counts(cell_days(raw)).first()) == (12, 10, 10, 9, 5)


def test_an_empty_table_has_counts(golden):
    assert tuple(load(golden.where("false")).counts.values()) == (0, 0, 0, 0, 0)


def test_day_sizes_need_no_second_scan(spark, sf_small):
    sized = with_day_sizes(cell_days(seismic_table(spark, sf_small)))
    with settings(spark, adaptive_enabled="false"):
        plan = sized._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1


def test_an_analysis_takes_half_the_jobs(spark, sf_small):
    """It took 46 with an action for every number that a step needs."""
    raw = seismic_table(spark, sf_small)
    assert jobs_of(spark, "analysis", lambda: analyse(raw).collect()) <= 23


def test_no_two_dates_share_a_bit(spark):
    dates = ["2024-01-01", "2024-01-31", "2024-02-01", "2024-01-62", "2024-01-63", "2024-01-99", "notadate!!"]
    dates += ["2024-01- 1", "2024-01-+1", "2024-01-1\n", "d1", "d100", "d163", "d112", "1", "01", ""]
    cells = spark.createDataFrame([(1.0, 2.0, d) for d in dates] + [(3.0, 4.0, dates[0])], "lat double, lon double, date string")
    words = day_bitmaps(cells)
    bits = {(r.lat, r.word): r.bits for r in words.collect()}
    assert sum(b.bit_count() if b >= 0 else (b + (1 << 64)).bit_count() for (lat, _), b in bits.items() if lat == 1.0) == len(dates)
    assert bits[1.0, "2024-01-"].bit_count() == 3
    assert rows(words.where("lat = 3").selectExpr("word", "bits")) == [("2024-01-", 2)]


@pytest.mark.parametrize("date", ["2024-01-05", "odd"])
def test_a_day_is_one_bit(spark, date):
    one = spark.createDataFrame([(1.0, 2.0, date)], "lat double, lon double, date string")
    assert bin(day_bitmaps(one).first().bits % (1 << 64)).count("1") == 1
