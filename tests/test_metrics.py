import pytest

from codays.fixed_values import METRIC_COLUMNS
from codays.plans.metrics import (
    METRICS_SCHEMA,
    Run,
    metrics_report,
    metrics_row,
    save_run,
    strategy_sweep,
    timed_run,
)
from codays.sinks.files import overwrite_csv

RESULT_SCHEMA = (
    "lat1 double, lon1 double, lat2 double, lon2 double, max_count long, n_dates int, "
    "dates array<string>, total_events long, unique_events long, co_occurrences long"
)
FOUND = (-12.3, 44.1, 5.6, -7.9, 2, 2, ["2021-07-02", "2021-08-15"], 10, 9, 5)
NONE = (None, None, None, None, 0, 0, [], 2, 2, 0)

# Labels of the report, in order.
REPORT = """
Approach: ReduceByKey
Partitioner: Hash (via repartition)
Workers: 2
Partitions: 16
Total Events: 10
Unique Events: 9
Co-occurrences: 5
Load Time: 1500ms (1.5s)
Analysis Time: 2500ms (2.5s)
Total Time: 4000ms (4.0s)
Max Co-occurrence Count: 2
Throughput: 2.5 events/sec
"""


def run_of(spark, row, load=1500, analysis=2500):
    result = spark.createDataFrame([row], RESULT_SCHEMA)
    return Run(result, metrics_row(result, "reducebykey", 2, 16, load, analysis, 1700000000000))


def text_of(folder):
    (part,) = folder.glob("part-*")
    return part.read_bytes().decode()


def test_report(spark):
    assert metrics_report(run_of(spark, FOUND).metrics).first().value == REPORT


def test_no_time_has_no_throughput(spark):
    report = metrics_report(run_of(spark, FOUND, 0, 0).metrics).first().value
    assert report.endswith("Throughput: n/a events/sec\n")


def test_saved_files(spark, tmp_path):
    out = tmp_path / "out"
    save_run(run_of(spark, FOUND), str(out))
    assert text_of(out) == "((-12.3, 44.1), (5.6, -7.9))\n2021-07-02\n2021-08-15\n"
    assert text_of(out / "metrics") == (
        "approach,num_workers,num_partitions,total_events,unique_events,co_occurrences,"
        "load_time_ms,analysis_time_ms,total_time_ms,max_count,timestamp\n"
        "ReduceByKey,2,16,10,9,5,1500,2500,4000,2,1700000000000\n"
    )
    assert text_of(out / "metrics-readable") == REPORT + "\n"


def test_second_run_replaces_the_first(spark, tmp_path):
    out = tmp_path / "out"
    save_run(run_of(spark, FOUND), str(out))
    save_run(run_of(spark, NONE), str(out))
    assert "".join(p.read_text() for p in out.glob("part-*")) == ""
    assert ",2,2,0,1500," in text_of(out / "metrics")


def test_csv_sink_replaces_and_reads_back(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_csv(spark.range(50).repartition(5), path)
    overwrite_csv(spark.range(3), path)
    read = spark.read.schema("id long").option("header", True).csv(path)
    assert sorted(r.id for r in read.collect()) == [0, 1, 2]


def test_timed_run(spark, golden):
    run = timed_run(golden, "2", 4, num_workers=3)
    row = run.metrics.first()
    assert tuple(run.metrics.columns) == METRIC_COLUMNS
    assert [f.dataType for f in run.metrics.schema] == [
        f.dataType for f in spark.createDataFrame([], METRICS_SCHEMA).schema
    ]
    assert (row.approach, row.num_workers, row.num_partitions, row.max_count) == ("AggregateByKey", 3, 4, 2)
    assert row.total_time_ms == row.load_time_ms + row.analysis_time_ms > 0
    assert run.result.first().dates == ["2021-07-02", "2021-08-15"]


@pytest.mark.parametrize("settings", [[(2, 2), (3, 4)]])
def test_sweep(golden, settings):
    rows = strategy_sweep(golden, settings).collect()
    assert [(r.num_workers, r.num_partitions, r.approach) for r in rows] == [
        (w, n, a) for w, n in settings for a in ("GroupByKey", "AggregateByKey", "ReduceByKey")
    ]
    assert {(r.total_events, r.unique_events, r.co_occurrences, r.max_count) for r in rows} == {(10, 9, 5, 2)}
