"""Registered queries and the SQL each one is checked against.

``entry(spark)`` runs the whole analysis on the smallest data set, ``queries()``
names every query, and ``oracle_sql()`` gives the same result as plain SQL over
the given tables. All of them read the ``events`` table in full.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codays.fixed_values import METRICS_FOLDER
from codays.operators.clean import parse_events, reject_audit, split_rejects
from codays.operators.contenders import most_frequent_pair
from codays.operators.counts import count_all_pairs
from codays.operators.folds import pair_spans
from codays.operators.grid import (
    cell_days,
    cells_per_day,
    grid_cells,
    repartitioned,
    row_counts,
    sized_cell_days,
    unique_events,
    valid_cell_days,
)
from codays.operators.pairs import (
    canonical_pairs,
    cooccurrences,
    cooccurrences_array,
    cooccurrences_blocked,
)
from codays.operators.result import top_pair_dates, with_labels
from codays.plans.analysis import (
    analyse,
    counts_row,
    load,
    load_cell_days,
    result_summary,
    result_text,
    winning_pair,
)
from codays.plans.metrics import (
    METRICS_SCHEMA,
    metrics_report,
    metrics_row,
    save_metrics_csv,
    strategy_sweep,
    timed_run,
)
from codays.session import staged, staging_path
from codays.sinks.files import overwrite_csv
from codays.sources.csv_events import load_event_files, load_events, read_event_csv
from codays.sources.seismic import seismic_table

try:  # the operators of training-data pipelines are an optional part
    import corpus_pipeline
    from codays.llm.queries import LLM_QUERIES, LLM_SQL
except ImportError as missing:
    if missing.name not in ("corpus_pipeline", "codays.llm", "codays.llm.queries"):
        warnings.warn(f"queries over texts and vectors are left out: {missing}", stacklevel=2)
    LLM_QUERIES, LLM_SQL, PIPELINE_QUERIES, PIPELINE_SQL = {}, {}, {}, {}
else:
    PIPELINE_QUERIES = {"pipeline": corpus_pipeline.run}
    PIPELINE_SQL = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}

SMOKE_FOLDER = "/root/testdata/sf0.001"
# Timings of the metrics queries, fixed so that their rows can be checked.
LOAD_MS, ANALYSIS_MS, FINISHED_MS = 1500, 3500, 1704067200000


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return parse_events(seismic_table(spark, folder))


def _unique(spark: SparkSession, folder: str) -> DataFrame:
    return valid_cell_days(cell_days(seismic_table(spark, folder)))


def _staged_unique(spark: SparkSession, folder: str) -> DataFrame:
    """For queries that read the unique rows more than once."""
    return sized_cell_days(load_cell_days(seismic_table(spark, folder)))


def _analysis(spark: SparkSession, folder: str) -> DataFrame:
    return analyse(seismic_table(spark, folder))


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = staging_path(spark, "csv")
    overwrite_csv(seismic_table(spark, folder).select("latitude", "longitude", "date"), path)
    return read_event_csv(spark, path)


def column_binding(spark: SparkSession, folder: str) -> DataFrame:
    raw = seismic_table(spark, folder)
    path = staging_path(spark, "csv")
    table = raw.select(
        F.when(F.col("event_id") % 7 != 0, F.col("latitude")).alias("c0"),
        F.col("longitude").alias("c1"),
        F.col("date").alias("c2"),
        F.when(F.col("event_id") % 97 == 0, "45.000").otherwise(F.col("latitude")).alias("latitude"),
    )
    overwrite_csv(table, path)
    return load_events(spark, path)


def _two_layouts(spark: SparkSession, folder: str) -> str:
    """Files of two layouts below one path: even ids go north, odd ones south.

    The header of the south has the latitude last, for rows without one in front.
    """
    path = staging_path(spark, "layouts")
    raw = seismic_table(spark, folder)
    overwrite_csv(raw.where("event_id % 2 = 0").select("latitude", "longitude", "date"), f"{path}/north")
    south = raw.where("event_id % 2 = 1").select(
        F.when(F.col("event_id") % 7 != 0, F.col("latitude")).alias("x"),
        "longitude",
        "date",
        F.when(F.col("event_id") % 11 != 0, F.col("latitude")).alias("latitude"),
    )
    overwrite_csv(south, f"{path}/south")
    return f"{path}/*"


def _side() -> Column:
    return F.regexp_extract("file", "/(north|south)/[^/]*$", 1).alias("side")


def many_files(spark: SparkSession, folder: str) -> DataFrame:
    rows = load_event_files(spark, _two_layouts(spark, folder))
    return rows.select(_side(), "latitude", "longitude", "date", "record")


def rejected_records(spark: SparkSession, folder: str) -> DataFrame:
    split = split_rejects(load_event_files(spark, _two_layouts(spark, folder)))
    return split.rejects.select(_side(), "record", "reason")


def split_events(spark: SparkSession, folder: str) -> DataFrame:
    split = split_rejects(load_event_files(spark, _two_layouts(spark, folder)))
    return split.events.select(_side(), "latitude", "longitude", "date")


def parsed(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).select("event_id", "latitude", "longitude", "date")


def top_pair_all(spark: SparkSession, folder: str) -> DataFrame:
    return most_frequent_pair(_staged_unique(spark, folder), search="all")


def top_pair_pruned(spark: SparkSession, folder: str) -> DataFrame:
    return most_frequent_pair(_staged_unique(spark, folder), "reducebykey", search="pruned")


def top_pair_without_second_day(spark: SparkSession, folder: str) -> DataFrame:
    """Each event a cell of its own, three to a day: no pair has a second day."""
    apart = _events(spark, folder).select(
        F.col("event_id").cast("double").alias("lat"),
        F.round("longitude", 1).alias("lon"),
        F.expr("cast(event_id div 3 AS string)").alias("date"),
    )
    return most_frequent_pair(staged(apart, "apart"))


def analysis_no_winner(spark: SparkSession, folder: str) -> DataFrame:
    """Every row on a day of its own, so that no two cells meet."""
    alone = F.when(F.length("date") >= 10, F.lpad(F.col("event_id").cast("string"), 10, "0"))
    result = analyse(seismic_table(spark, folder).withColumn("date", F.coalesce(alone, "date")))
    return result.withColumn("dates", F.array_join("dates", ","))


def checked_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """A timed run, its clock columns turned into facts that hold whenever it ran."""
    return timed_run(seismic_table(spark, folder), num_partitions=8).metrics.select(
        "approach",
        "num_workers",
        "num_partitions",
        "total_events",
        "unique_events",
        "co_occurrences",
        "max_count",
        (F.col("load_time_ms") >= 0).alias("load_timed"),
        (F.col("analysis_time_ms") >= 0).alias("analysis_timed"),
        (F.col("total_time_ms") == F.col("load_time_ms") + F.col("analysis_time_ms")).alias("total_is_sum"),
        (F.col("timestamp") > 0).alias("stamped"),
    )


def labels(spark: SparkSession, folder: str) -> DataFrame:
    counts = count_all_pairs(_staged_unique(spark, folder), "reducebykey")
    return with_labels(counts).select("label1", "label2", "label", "n")


def winner_dates(spark: SparkSession, folder: str) -> DataFrame:
    days = load_cell_days(seismic_table(spark, folder))
    return top_pair_dates(valid_cell_days(days), winning_pair(days))


def analysis_row(spark: SparkSession, folder: str) -> DataFrame:
    return _analysis(spark, folder).withColumn("dates", F.array_join("dates", ","))


def _fixed_metrics(spark: SparkSession, folder: str) -> DataFrame:
    result = analyse(seismic_table(spark, folder), "groupbykey")
    return metrics_row(result, "groupbykey", 1, 8, LOAD_MS, ANALYSIS_MS, FINISHED_MS)


def metrics_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = staging_path(spark, "run")
    save_metrics_csv(_fixed_metrics(spark, folder), path)
    return spark.read.schema(METRICS_SCHEMA).option("header", True).csv(f"{path}/{METRICS_FOLDER}")


def overwrite_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = staging_path(spark, "unique")
    overwrite_csv(grid_cells(_events(spark, folder)).select("lat", "lon", "date"), path)
    overwrite_csv(_unique(spark, folder), path)
    return spark.read.schema("lat double, lon double, date string").option("header", True).csv(path)


def sweep(spark: SparkSession, folder: str) -> DataFrame:
    return strategy_sweep(seismic_table(spark, folder)).select(
        "approach",
        "num_workers",
        "num_partitions",
        "total_events",
        "unique_events",
        "co_occurrences",
        F.col("max_count").cast("long").alias("max_count"),
    )


def entry(spark: SparkSession) -> DataFrame:
    """The analysis on the smallest data set."""
    return analysis_row(spark, SMOKE_FOLDER)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name; each takes (spark, folder) and returns a DataFrame."""
    return {
        "csv_scan": csv_scan,
        "column_binding": column_binding,
        "many_files": many_files,
        "rejected_records": rejected_records,
        "split_events": split_events,
        "pair_spans": lambda spark, folder: pair_spans(_staged_unique(spark, folder)),
        "parse_events": parsed,
        "reject_audit": lambda spark, folder: reject_audit(seismic_table(spark, folder)),
        "grid_cells": lambda spark, folder: grid_cells(_events(spark, folder)),
        "unique_events": lambda spark, folder: unique_events(grid_cells(_events(spark, folder))),
        "repartitioned_events": lambda spark, folder: repartitioned(_unique(spark, folder), 8),
        "cells_per_day": lambda spark, folder: cells_per_day(_unique(spark, folder)),
        "row_counts": lambda spark, folder: row_counts(cell_days(seismic_table(spark, folder))),
        "loaded_counts": lambda spark, folder: counts_row(spark, load(seismic_table(spark, folder)).counts),
        "cooccurrences": lambda spark, folder: cooccurrences(_staged_unique(spark, folder)),
        "cooccurrences_array": lambda spark, folder: cooccurrences_array(
            _staged_unique(spark, folder)
        ),
        "cooccurrences_blocked": lambda spark, folder: cooccurrences_blocked(
            _staged_unique(spark, folder), 4
        ),
        "canonical_pairs": lambda spark, folder: canonical_pairs(_staged_unique(spark, folder)),
        "pair_counts_group": lambda spark, folder: count_all_pairs(
            _staged_unique(spark, folder), "groupbykey"
        ),
        "pair_counts_aggregate": lambda spark, folder: count_all_pairs(
            _staged_unique(spark, folder), "aggregatebykey"
        ),
        "pair_counts_reduce": lambda spark, folder: count_all_pairs(
            _staged_unique(spark, folder), "reducebykey"
        ),
        "cooccurrences_split": lambda spark, folder: cooccurrences(
            _staged_unique(spark, folder), cells_per_block=64
        ),
        "cooccurrences_array_split": lambda spark, folder: cooccurrences_array(
            _staged_unique(spark, folder), cells_per_block=64
        ),
        "top_pair": lambda spark, folder: most_frequent_pair(_staged_unique(spark, folder)),
        "top_pair_without_second_day": top_pair_without_second_day,
        "analysis_no_winner": analysis_no_winner,
        "top_pair_all": top_pair_all,
        "top_pair_pruned": top_pair_pruned,
        "pair_label": labels,
        "top_pair_dates": winner_dates,
        "analysis_result": analysis_row,
        "result_summary": lambda spark, folder: result_summary(_analysis(spark, folder)),
        "result_text": lambda spark, folder: result_text(_analysis(spark, folder)),
        "metrics_report": lambda spark, folder: metrics_report(_fixed_metrics(spark, folder)),
        "metrics_csv": metrics_csv,
        "overwrite_sink": overwrite_sink,
        "run_metrics": checked_metrics,
        "strategy_sweep": sweep,
        **LLM_QUERIES,
        **PIPELINE_QUERIES,
    }


_RAW = """
raw AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0 THEN 'n/a'
         ELSE (lat_m // 1000) || '.' || lpad(CAST(lat_m % 1000 AS VARCHAR), 3, '0') END AS latitude,
    CASE WHEN event_id % 103 <> 0
         THEN (lon_m // 1000) || '.' || lpad(CAST(lon_m % 1000 AS VARCHAR), 3, '0') END AS longitude,
    CASE WHEN event_id % 101 = 0 THEN substr(stamp, 1, 7) ELSE stamp END AS date
  FROM (
    SELECT event_id,
      36000 + ((user_id % 400) * 173) % 9000 + event_id % 60 AS lat_m,
      7000 + ((user_id % 400) * 911) % 11000 + (event_id * 7) % 60 AS lon_m,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp
    FROM events))"""

_EVENTS = (
    _RAW
    + """,
parsed AS (
  SELECT event_id, TRY_CAST(latitude AS DOUBLE) AS latitude,
    TRY_CAST(longitude AS DOUBLE) AS longitude,
    CASE WHEN length(date) >= 10 THEN substr(date, 1, 10) END AS date
  FROM raw),
valid AS (
  SELECT * FROM parsed
  WHERE isfinite(latitude) AND isfinite(longitude) AND date IS NOT NULL),
cells AS (
  SELECT event_id, round(latitude, 1) AS lat, round(longitude, 1) AS lon, date FROM valid),
uniq AS (SELECT DISTINCT lat, lon, date FROM cells)"""
)

_PAIRS = (
    _EVENTS
    + """,
instances AS (
  SELECT a.lat AS lat1, a.lon AS lon1, b.lat AS lat2, b.lon AS lon2, a.date AS date
  FROM uniq a JOIN uniq b
    ON a.date = b.date AND (a.lat < b.lat OR (a.lat = b.lat AND a.lon < b.lon))),
counted AS (
  SELECT lat1, lon1, lat2, lon2, CAST(count(*) AS BIGINT) AS n
  FROM instances GROUP BY lat1, lon1, lat2, lon2)"""
)

_TOP = (
    _PAIRS
    + """,
top AS (
  SELECT * FROM counted ORDER BY n DESC, lat1, lon1, lat2, lon2 LIMIT 1),
won AS (
  SELECT DISTINCT lat1, lon1, lat2, lon2, date
  FROM instances JOIN top USING (lat1, lon1, lat2, lon2))"""
)

_ANALYSIS = (
    _TOP
    + """,
totals AS (
  SELECT (SELECT CAST(count(*) AS BIGINT) FROM cells) AS total_events,
    (SELECT CAST(count(*) AS BIGINT) FROM uniq) AS unique_events,
    (SELECT CAST(count(*) AS BIGINT) FROM instances) AS co_occurrences),
days AS (
  SELECT CAST(count(*) AS INTEGER) AS n_dates, min(date) AS first_date, max(date) AS last_date,
    string_agg(date, ',' ORDER BY date) AS dates FROM won)"""
)

_LABEL1 = "'(' || lat1 || ', ' || lon1 || ')'"
_LABEL2 = "'(' || lat2 || ', ' || lon2 || ')'"

# Columns of the metrics table, here and in the queries on metrics.
_METRICS = (
    _ANALYSIS
    + f""",
metrics AS (
  SELECT 'GroupByKey' AS approach, CAST(1 AS INTEGER) AS num_workers,
    CAST(8 AS INTEGER) AS num_partitions, total_events, unique_events, co_occurrences,
    CAST({LOAD_MS} AS BIGINT) AS load_time_ms, CAST({ANALYSIS_MS} AS BIGINT) AS analysis_time_ms,
    CAST({LOAD_MS + ANALYSIS_MS} AS BIGINT) AS total_time_ms,
    CAST(top.n AS INTEGER) AS max_count, CAST({FINISHED_MS} AS BIGINT) AS timestamp
  FROM totals, top)"""
)


def oracle_sql() -> dict[str, str]:
    """The same results as SQL."""
    instances = f"WITH {_PAIRS} SELECT lat1, lon1, lat2, lon2, date FROM instances"
    counts = f"WITH {_PAIRS} SELECT lat1, lon1, lat2, lon2, n FROM counted"
    top = f"WITH {_TOP} SELECT lat1, lon1, lat2, lon2, n FROM top"
    unique = f"WITH {_EVENTS} SELECT lat, lon, date FROM uniq"
    reasons = """CASE
        WHEN latitude IS NULL OR latitude = '' THEN 'latitude missing'
        WHEN TRY_CAST(latitude AS DOUBLE) IS NULL THEN 'latitude not a number'
        WHEN NOT isfinite(TRY_CAST(latitude AS DOUBLE)) THEN 'latitude not finite'
        WHEN longitude IS NULL OR longitude = '' THEN 'longitude missing'
        WHEN TRY_CAST(longitude AS DOUBLE) IS NULL THEN 'longitude not a number'
        WHEN NOT isfinite(TRY_CAST(longitude AS DOUBLE)) THEN 'longitude not finite'
        WHEN date IS NULL OR date = '' THEN 'date missing'
        WHEN length(date) < 10 THEN 'date too short' END"""
    layouts = f"""{_RAW}, lines AS (
        SELECT 'north' AS side, latitude, longitude, date,
          concat_ws(',', coalesce(latitude, ''), coalesce(longitude, ''), date) AS record
        FROM raw WHERE event_id % 2 = 0
        UNION ALL
        SELECT 'south', CASE WHEN event_id % 7 <> 0 OR event_id % 11 <> 0 THEN latitude END, longitude, date,
          concat_ws(',', CASE WHEN event_id % 7 <> 0 THEN latitude ELSE '' END, coalesce(longitude, ''), date,
            CASE WHEN event_id % 11 <> 0 THEN latitude ELSE '' END)
        FROM raw WHERE event_id % 2 = 1)"""
    row_numbers = f"""WITH {_PAIRS}
        SELECT (SELECT CAST(count(*) AS BIGINT) FROM raw) AS raw_rows,
          (SELECT CAST(count(*) AS BIGINT) FROM valid) AS valid_rows,
          (SELECT CAST(count(*) AS BIGINT) FROM cells) AS total_events,
          (SELECT CAST(count(*) AS BIGINT) FROM uniq) AS unique_events,
          (SELECT CAST(count(*) AS BIGINT) FROM instances) AS co_occurrences"""
    return {
        "csv_scan": f"WITH {_RAW} SELECT latitude, longitude, date FROM raw",
        "column_binding": f"""WITH {_RAW}
            SELECT CASE WHEN event_id % 7 = 0 AND event_id % 97 = 0 THEN '45.000'
                        ELSE latitude END AS latitude, longitude, date
            FROM raw""",
        "many_files": f"WITH {layouts} SELECT side, latitude, longitude, date, record FROM lines",
        "rejected_records": f"""WITH {layouts}
            SELECT side, record, reason FROM (SELECT *, {reasons} AS reason FROM lines) WHERE reason IS NOT NULL""",
        "split_events": f"""WITH {layouts}
            SELECT side, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
              substr(date, 1, 10) AS date
            FROM (SELECT *, {reasons} AS reason FROM lines) WHERE reason IS NULL""",
        "pair_spans": f"""WITH {_PAIRS}
            SELECT lat1, lon1, lat2, lon2, min(date) AS first_day, max(date) AS last_day,
              CAST(count(*) AS BIGINT) AS n_days
            FROM instances GROUP BY lat1, lon1, lat2, lon2""",
        "parse_events": f"WITH {_EVENTS} SELECT event_id, latitude, longitude, date FROM valid",
        "reject_audit": f"""WITH {_RAW}
            SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (SELECT {reasons} AS reason FROM raw)
            WHERE reason IS NOT NULL GROUP BY reason""",
        "grid_cells": f"WITH {_EVENTS} SELECT event_id, lat, lon, date FROM cells",
        "unique_events": unique,
        "repartitioned_events": unique,
        "cells_per_day": f"""WITH {_EVENTS}
            SELECT date, CAST(count(*) AS BIGINT) AS n_cells,
              CAST(count(*) * (count(*) - 1) // 2 AS BIGINT) AS n_pairs
            FROM uniq GROUP BY date""",
        "row_counts": row_numbers,
        "loaded_counts": row_numbers,
        "cooccurrences": instances,
        "cooccurrences_array": instances,
        "cooccurrences_blocked": instances,
        "cooccurrences_split": instances,
        "cooccurrences_array_split": instances,
        "canonical_pairs": f"WITH {_PAIRS} SELECT DISTINCT lat1, lon1, lat2, lon2 FROM instances",
        "pair_counts_group": counts,
        "pair_counts_aggregate": counts,
        "pair_counts_reduce": counts,
        "top_pair": top,
        "top_pair_all": top,
        "top_pair_pruned": top,
        "top_pair_without_second_day": f"""WITH {_EVENTS},
            apart AS (
              SELECT CAST(event_id AS DOUBLE) AS lat, round(longitude, 1) AS lon, event_id // 3 AS date FROM valid)
            SELECT a.lat AS lat1, a.lon AS lon1, b.lat AS lat2, b.lon AS lon2, CAST(1 AS BIGINT) AS n
            FROM apart a JOIN apart b ON a.date = b.date AND a.lat < b.lat
            ORDER BY lat1, lon1, lat2, lon2 LIMIT 1""",
        "analysis_no_winner": f"""WITH {_EVENTS}
            SELECT CAST(NULL AS DOUBLE) AS lat1, CAST(NULL AS DOUBLE) AS lon1, CAST(NULL AS DOUBLE) AS lat2,
              CAST(NULL AS DOUBLE) AS lon2, CAST(0 AS BIGINT) AS max_count, CAST(0 AS INTEGER) AS n_dates,
              '' AS dates, CAST(count(*) AS BIGINT) AS total_events, CAST(count(*) AS BIGINT) AS unique_events,
              CAST(0 AS BIGINT) AS co_occurrences
            FROM valid""",
        "pair_label": f"""WITH {_PAIRS}
            SELECT {_LABEL1} AS label1, {_LABEL2} AS label2,
              '(' || {_LABEL1} || ', ' || {_LABEL2} || ')' AS label, n FROM counted""",
        "top_pair_dates": f"WITH {_TOP} SELECT date FROM won ORDER BY date",
        "analysis_result": f"""WITH {_ANALYSIS}
            SELECT lat1, lon1, lat2, lon2, n AS max_count, n_dates, dates,
              total_events, unique_events, co_occurrences
            FROM top, days, totals""",
        "result_summary": f"""WITH {_ANALYSIS}
            SELECT lat1, lon1, lat2, lon2, n_dates, total_events, unique_events, co_occurrences,
              first_date, last_date,
              (SELECT string_agg(date, ', ' ORDER BY date)
               FROM (SELECT date, row_number() OVER (ORDER BY date) AS k FROM won)
               WHERE k <= CASE WHEN n_dates <= 10 THEN 10 ELSE 5 END) AS preview,
              CAST(CASE WHEN n_dates <= 10 THEN 0 ELSE n_dates - 5 END AS INTEGER) AS more_dates
            FROM top, days, totals""",
        "result_text": f"""WITH {_ANALYSIS}
            SELECT '(' || {_LABEL1} || ', ' || {_LABEL2} || ')' || chr(10)
              || replace(dates, ',', chr(10)) AS value
            FROM top, days""",
        # Labels of the report, in order.
        "metrics_report": f"""WITH {_METRICS}
            SELECT chr(10) || 'Approach: ' || approach
              || chr(10) || 'Partitioner: Hash (via repartition)'
              || chr(10) || 'Workers: ' || num_workers
              || chr(10) || 'Partitions: ' || num_partitions
              || chr(10) || 'Total Events: ' || total_events
              || chr(10) || 'Unique Events: ' || unique_events
              || chr(10) || 'Co-occurrences: ' || co_occurrences
              || chr(10) || 'Load Time: ' || load_time_ms
              || 'ms (' || CAST(load_time_ms / 1000.0 AS DOUBLE) || 's)'
              || chr(10) || 'Analysis Time: ' || analysis_time_ms
              || 'ms (' || CAST(analysis_time_ms / 1000.0 AS DOUBLE) || 's)'
              || chr(10) || 'Total Time: ' || total_time_ms
              || 'ms (' || CAST(total_time_ms / 1000.0 AS DOUBLE) || 's)'
              || chr(10) || 'Max Co-occurrence Count: ' || max_count
              || chr(10) || 'Throughput: '
              || CAST(total_events * 1000.0 / total_time_ms AS DOUBLE) || ' events/sec'
              || chr(10) AS value
            FROM metrics""",
        "metrics_csv": f"""WITH {_METRICS}
            SELECT approach, num_workers, num_partitions, total_events, unique_events,
              co_occurrences, load_time_ms, analysis_time_ms, total_time_ms, max_count, timestamp
            FROM metrics""",
        "overwrite_sink": unique,
        "run_metrics": f"""WITH {_ANALYSIS}
            SELECT 'GroupByKey' AS approach, CAST(1 AS INTEGER) AS num_workers,
              CAST(8 AS INTEGER) AS num_partitions, total_events, unique_events, co_occurrences,
              CAST(n AS INTEGER) AS max_count, true AS load_timed, true AS analysis_timed,
              true AS total_is_sum, true AS stamped
            FROM totals, top""",
        "strategy_sweep": f"""WITH {_ANALYSIS}
            SELECT approach, CAST(num_workers AS INTEGER) AS num_workers,
              CAST(num_partitions AS INTEGER) AS num_partitions,
              total_events, unique_events, co_occurrences, n AS max_count
            FROM totals, top,
              (VALUES ('GroupByKey'), ('AggregateByKey'), ('ReduceByKey')) s(approach),
              (VALUES (2, 8), (2, 16), (2, 32), (2, 48), (3, 16), (3, 32), (3, 48), (4, 16), (4, 32), (4, 48))
                p(num_workers, num_partitions)""",
        **LLM_SQL,
        **PIPELINE_SQL,
    }
