from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from codays.functions import ordered_pair, pair_label, to_grid
from codays.operators.clean import parse_events
from codays.operators.grid import (
    cell_days,
    cells_per_day,
    grid_cells,
    repartitioned,
    row_counts,
    unique_events,
    valid_cell_days,
)

from brute import rows


def test_rounding_is_half_up_away_from_zero(spark):
    values = [0.05, 0.15, 0.25, 36.05, 36.149, -0.04, -0.05, -37.25, 89.95, -179.95, 999.95, 1e7 + 0.05]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(to_grid(F.col("x")).alias("r"))
    expected = [float(Decimal(repr(v)).quantize(Decimal("0.1"), ROUND_HALF_UP)) + 0.0 for v in values]
    assert [str(row.r) for row in got.collect()] == [str(e) for e in expected]


def test_golden_counts(golden):
    counts = row_counts(cell_days(golden)).first()
    assert tuple(counts) == (10, 10, 10, 9, 5)


def test_rejected_rows_are_counted_as_raw_only(spark, golden):
    dirty = spark.createDataFrame([("x", "1", "2024-03-12"), (None, "1", "2024-03-12")], golden.schema)
    assert tuple(row_counts(cell_days(golden.union(dirty))).first()) == (12, 10, 10, 9, 5)


def test_empty_counts(golden):
    assert tuple(row_counts(cell_days(golden.where("false"))).first()) == (0, 0, 0, 0, 0)


def test_unique_both_ways(golden):
    direct = unique_events(grid_cells(parse_events(golden)))
    assert rows(direct) == rows(valid_cell_days(cell_days(golden)))
    assert direct.count() == 9


def test_cells_per_day(golden):
    per_day = cells_per_day(unique_events(grid_cells(parse_events(golden))))
    assert rows(per_day) == [
        ("2021-07-02", 2, 1),
        ("2021-07-09", 2, 1),
        ("2021-08-15", 3, 3),
        ("2021-09-20", 1, 0),
        ("2021-09-27", 1, 0),
    ]


def test_repartition_keeps_rows(golden):
    unique = unique_events(grid_cells(parse_events(golden)))
    for spread in (repartitioned(unique, 7), repartitioned(unique, 7, "date")):
        plan = spread._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" in plan and ("(7)" in plan or ", 7)" in plan)
        assert rows(spread) == rows(unique)


def test_pair_is_put_in_order(spark):
    df = spark.createDataFrame(
        [(2.0, 1.0, 1.0, 5.0), (1.0, 5.0, 1.0, 2.0), (1.0, 2.0, 1.0, 2.0), (1.0, 2.0, 1.0, 3.0)],
        "a double, b double, c double, d double",
    )
    got = df.select(*ordered_pair(*[F.col(c) for c in "abcd"]))
    assert [tuple(r) for r in got.collect()] == [
        (1.0, 5.0, 2.0, 1.0),
        (1.0, 2.0, 1.0, 5.0),
        (1.0, 2.0, 1.0, 2.0),
        (1.0, 2.0, 1.0, 3.0),
    ]


def test_pair_label(spark):
    df = spark.createDataFrame([(37.5, -15.0, 1000.0, 0.0)], "a double, b double, c double, d double")
    label = df.select(pair_label(*[F.col(c) for c in "abcd"]).alias("v")).first().v
    assert label == "((37.5, -15.0), (1000.0, 0.0))"
