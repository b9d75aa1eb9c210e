"""A given number of partitions rules the run; the metrics row reports what ran."""

import pytest
from pyspark.sql import functions as F

from codays.operators.contenders import find_winner
from codays.operators.pairs import (
    PAIRS_PER_TASK,
    number_of_pairs,
    packed,
    rectangle_sizes,
    tiled_cooccurrences,
    triangle_sizes,
)
from codays.plans.metrics import timed_run
from codays.session import staged

import brute
from brute import rows


def test_largest_tiles_are_packed_first():
    given = packed({0: 5, 1: 4, 2: 3, 3: 3, 4: 3}, 2)
    assert [sorted(t for t in given if given[t] == task) for task in (0, 1)] == [[0, 3], [1, 2, 4]]
    assert packed({}, 3) == {}


@pytest.fixture(scope="module")
def uneven(spark):
    """Days from quiet to crowded, and cells from seldom to always there."""
    made = spark.range(40_000).selectExpr(
        "double(int(pow(id % 331, 1.3)) % 700) AS lat", "0D AS lon", "concat('2024-01-', lpad(int(sqrt(id % 900)), 2, '0')) AS date"
    )
    return staged(made.distinct(), "uneven")


def test_tile_sizes_are_exact(uneven):
    sizes = triangle_sizes(uneven, 5)
    assert sum(sizes.values()) == number_of_pairs(uneven) == len(brute.instances(rows(uneven)))
    left = uneven.where("lat < 100")
    met = left.count() and left.toDF("a", "b", "date").join(uneven, "date").count()
    assert sum(rectangle_sizes(left, uneven, 4).values()) == met


@pytest.mark.parametrize("n", [3, 8, 16])
def test_a_given_width_makes_so_many_even_tasks(uneven, n):
    tiled = tiled_cooccurrences(uneven, n)
    per_task = tiled.groupBy(F.spark_partition_id().alias("p"), "task").count().collect()
    sizes = [r["count"] for r in per_task]
    assert len(sizes) == len({r.p for r in per_task}) == len({r.task for r in per_task}) == n
    assert sum(sizes) == number_of_pairs(uneven)
    assert max(sizes) <= 1.2 * sum(sizes) / n


def test_a_given_width_holds_for_many_pairs(spark):
    """More pairs than a task would take by itself stay in as many tasks as asked for."""
    crowd = spark.range(3400).selectExpr("double(id) AS lat", "0D AS lon", "'2024-01-01' AS date")
    unique = staged(crowd, "crowd")
    assert number_of_pairs(unique) > 2 * PAIRS_PER_TASK
    assert tiled_cooccurrences(unique, 2).rdd.getNumPartitions() == 2
    raw = crowd.selectExpr("string(lat) AS latitude", "string(lon) AS longitude", "date")
    assert timed_run(raw, "3", 2).metrics.first().num_partitions == 2
    assert find_winner(unique, "3", 2, "all").tasks == 2
    assert find_winner(unique, "3", None, "all").tasks == 4


def test_without_a_width_the_row_tells_the_tasks_that_ran(golden):
    assert timed_run(golden).metrics.first().num_partitions == 4  # the session's own
