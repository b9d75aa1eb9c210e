"""Timed runs, their metrics rows, files and sweeps."""

import time
from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codays.fixed_values import (
    DEFAULT_STRATEGY,
    METRIC_COLUMNS,
    METRICS_FOLDER,
    REPORT_FOLDER,
    STRATEGY_NAMES,
    SWEEP_PARTITIONS,
)
from codays.operators.counts import parse_strategy, strategy_name
from codays.plans.analysis import Loaded, analyse_loaded, load, result_text
from codays.session import staged
from codays.sinks.files import overwrite_csv, overwrite_text

METRICS_SCHEMA = (
    "approach string, num_workers int, num_partitions int, total_events bigint, "
    "unique_events bigint, co_occurrences bigint, load_time_ms bigint, "
    "analysis_time_ms bigint, total_time_ms bigint, max_count int, timestamp bigint"
)


class Run(NamedTuple):
    result: DataFrame
    metrics: DataFrame


def _now_ms() -> int:
    return int(time.time() * 1000)


def metrics_row(
    result: DataFrame,
    strategy: str,
    num_workers: int,
    num_partitions: int,
    load_ms: int,
    analysis_ms: int,
    timestamp: int,
) -> DataFrame:
    """One metrics row; the number of workers is only recorded.

    ``num_partitions`` is the number of tasks that counted pairs.
    """
    given = {
        "approach": F.lit(strategy_name(strategy)),
        "num_workers": F.lit(num_workers),
        "num_partitions": F.lit(num_partitions),
        "load_time_ms": F.lit(load_ms).cast("long"),
        "analysis_time_ms": F.lit(analysis_ms).cast("long"),
        "total_time_ms": F.lit(load_ms + analysis_ms).cast("long"),
        "max_count": F.col("max_count").cast("int"),
        "timestamp": F.lit(timestamp).cast("long"),
    }
    return result.select(*[given.get(c, F.col(c)).alias(c) for c in METRIC_COLUMNS])


def _timed_analysis(
    loaded: Loaded,
    load_ms: int,
    strategy: str,
    num_partitions: int | None,
    num_workers: int,
    search: str = "pruned",
) -> Run:
    strategy = parse_strategy(strategy)
    start = _now_ms()
    analysis = analyse_loaded(loaded, strategy, num_partitions, search)
    result = staged(analysis.result, "result")
    end = _now_ms()
    metrics = metrics_row(result, strategy, num_workers, analysis.tasks, load_ms, end - start, end)
    return Run(result, metrics)


def _timed_load(raw: DataFrame) -> tuple[Loaded, int]:
    start = _now_ms()
    loaded = load(raw)
    return loaded, _now_ms() - start


def timed_run(
    raw: DataFrame,
    strategy: str = DEFAULT_STRATEGY,
    num_partitions: int | None = None,
    num_workers: int = 1,
) -> Run:
    """Load and analyse with each part timed around its action; saving is not timed.

    A given ``num_partitions`` is the exact number of tasks that count pairs.
    """
    loaded, load_ms = _timed_load(raw)
    return _timed_analysis(loaded, load_ms, strategy, num_partitions, num_workers)


def strategy_sweep(
    raw: DataFrame,
    settings: Iterable[tuple[int, int]] | None = None,
    strategies: Iterable[str] = tuple(STRATEGY_NAMES),
    search: str = "all",
) -> DataFrame:
    """One metrics row per (workers, partitions) setting and strategy.

    The raw rows are loaded once; each run repeats the analysis. As strategies
    differ in how they count pairs, runs count all of them unless told otherwise.
    """
    if settings is None:
        settings = [(w, n) for w, counts in SWEEP_PARTITIONS.items() for n in counts]
    loaded, load_ms = _timed_load(raw)
    rows = [
        _timed_analysis(loaded, load_ms, strategy, partitions, workers, search).metrics
        for workers, partitions in settings
        for strategy in strategies
    ]
    return reduce(DataFrame.unionByName, rows)


def metrics_report(metrics: DataFrame) -> DataFrame:
    """The readable report of each metrics row as one text value."""

    def text(column):
        return F.col(column).cast("string")

    def duration(column):
        seconds = (F.col(column) / F.lit(1000.0)).cast("string")
        return F.concat(text(column), F.lit("ms ("), seconds, F.lit("s)"))

    throughput = F.try_divide(F.col("total_events") * F.lit(1000.0), F.col("total_time_ms"))
    # Labels of the report, in order.
    lines = [
        ("Approach", F.col("approach")),
        ("Partitioner", F.lit("Hash (via repartition)")),
        ("Workers", text("num_workers")),
        ("Partitions", text("num_partitions")),
        ("Total Events", text("total_events")),
        ("Unique Events", text("unique_events")),
        ("Co-occurrences", text("co_occurrences")),
        ("Load Time", duration("load_time_ms")),
        ("Analysis Time", duration("analysis_time_ms")),
        ("Total Time", duration("total_time_ms")),
        ("Max Co-occurrence Count", text("max_count")),
        (
            "Throughput",
            F.concat(F.coalesce(throughput.cast("string"), F.lit("n/a")), F.lit(" events/sec")),
        ),
    ]
    labelled = [F.concat(F.lit(f"{label}: "), value) for label, value in lines]
    return metrics.select(F.concat_ws("\n", F.lit(""), *labelled, F.lit("")).alias("value"))


def save_metrics_csv(metrics: DataFrame, output_path: str) -> None:
    overwrite_csv(metrics, f"{output_path}/{METRICS_FOLDER}", single_file=True)


def save_metrics_report(metrics: DataFrame, output_path: str) -> None:
    overwrite_text(metrics_report(metrics), f"{output_path}/{REPORT_FOLDER}")


def save_run(run: Run, output_path: str) -> None:
    """Result first: it replaces the folder that the metrics then go below."""
    overwrite_text(result_text(run.result), output_path)
    save_metrics_csv(run.metrics, output_path)
    save_metrics_report(run.metrics, output_path)
