import random

import pytest
from pyspark.sql import functions as F

from codays.functions import PAIR
from codays.operators.counts import (
    count_all_pairs,
    pair_counts,
    parse_strategy,
    strategy_name,
)
from codays.operators.pairs import (
    canonical_pairs,
    cooccurrences,
    cooccurrences_array,
    cooccurrences_blocked,
    crowded_days,
    rectangular_cooccurrences,
    tasks_for,
    tiled_cooccurrences,
    triangular_pairs,
    with_day_blocks,
)
from codays.operators.result import top_pair

import brute
from brute import rows

UNIQUE = "lat double, lon double, date string"


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    cells = [(i / 10, j / 10) for i in range(8) for j in range(8)]
    out = {(*c, "2024-01-01") for c in cells}  # a crowded day
    out |= {(*rng.choice(cells), f"2024-01-{rng.randint(2, 20):02d}") for _ in range(90)}
    out.add((9.9, 9.9, "2024-02-01"))  # a lonely cell
    return sorted(out)


@pytest.fixture(scope="module")
def unique(spark, data):
    return spark.createDataFrame(data, UNIQUE).cache()


FORMS = {
    "join": lambda u, n: cooccurrences(u, n),
    "array": lambda u, n: cooccurrences_array(u, n),
    "blocked": lambda u, n: cooccurrences_blocked(u, 3, n),
    "one block": lambda u, n: cooccurrences_blocked(u, 1, n),
    "tiles": lambda u, n: tiled_cooccurrences(u, n).select(*PAIR, "date"),
    "small tiles": lambda u, n: tiled_cooccurrences(u, n, cells_per_block=5).select(*PAIR, "date"),
}


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("partitions", [1, 8])
def test_every_form_gives_every_pair_once(unique, data, form, partitions):
    assert rows(FORMS[form](unique, partitions)) == brute.instances(data)


def test_crowded_days_are_split(unique, data):
    crowded = crowded_days(unique, cells_per_block=10)
    assert rows(crowded.select("date", "blocks"))[0] == ("2024-01-01", 7)
    blocked = with_day_blocks(unique, crowded)
    assert rows(triangular_pairs(blocked, 4)) == brute.instances(data)


def test_a_crowded_day_leaves_quiet_rows_alone(spark):
    """Only its own rows are cut into parts; how often a quiet row is repeated stays the same."""
    quiet = spark.range(300).selectExpr("double(id) AS lat", "0D AS lon", "concat('q', id % 10) AS date")
    hot = spark.range(60_000).selectExpr("double(id) AS lat", "1D AS lon", "'hot' AS date")
    for table, parts in ((quiet, {1}), (quiet.union(hot), {1, 15})):
        rows_of = with_day_blocks(table, crowded_days(table, 4096))
        assert {r.blocks for r in rows_of.select("blocks").distinct().collect()} == parts
        assert {r.blocks for r in rows_of.where("date != 'hot'").select("blocks").distinct().collect()} == {1}


def test_tiles_are_dealt_evenly(spark):
    spread = spark.range(4000).selectExpr("double(id % 800) AS lat", "0D AS lon", "concat('d', id % 5) AS date")
    for tasks in (8, 32):
        sizes = [r["count"] for r in tiled_cooccurrences(spread, tasks).groupBy("task").count().collect()]
        assert len(sizes) == tasks and max(sizes) <= 1.5 * sum(sizes) / tasks


def test_tasks_follow_the_number_of_pairs(spark):
    assert [tasks_for(spark, n) for n in (0, 16_000_000, 10**12)] == [4, 8, 500_000]
    assert [tasks_for(spark, n, 6) for n in (0, 16_000_000, 10**12)] == [6, 6, 6]


def test_rectangles_give_each_pair_once(spark, unique, data):
    left = unique.where("lat < 0.3")
    found = rectangular_cooccurrences(left, unique, 1000, 4, cells_per_block=3).select(*PAIR, "date")
    assert rows(found) == [r for r in brute.instances(data) if r[0] < 0.3]


def test_carried_columns_follow_their_cell(unique):
    tagged = unique.withColumn("tag", F.col("lat") * 100 + F.col("lon")).withColumn("blocks", F.lit(4))
    pairs = triangular_pairs(tagged, 4, carry=("tag",))
    right = (F.col("tag1") == F.col("lat1") * 100 + F.col("lon1")) & (
        F.col("tag2") == F.col("lat2") * 100 + F.col("lon2")
    )
    assert pairs.where(~right).count() == 0


def test_canonical_pairs(unique, data):
    assert rows(canonical_pairs(unique)) == sorted(brute.counts(data))


@pytest.mark.parametrize("strategy", ["1", "AggregateByKey", "REDUCEBYKEY"])
def test_strategies_agree(unique, data, strategy):
    expected = sorted((*pair, n) for pair, n in brute.counts(data).items())
    assert rows(count_all_pairs(unique, strategy)) == expected
    assert rows(pair_counts(cooccurrences(unique), strategy)) == expected


def test_strategy_names():
    assert [parse_strategy(s) for s in ("GroupByKey", "2", "reducebykey")] == [
        "groupbykey",
        "aggregatebykey",
        "reducebykey",
    ]
    with pytest.warns(UserWarning, match="unknown strategy"):
        assert parse_strategy("sort") == "groupbykey"
    assert [strategy_name(s) for s in ("groupbykey", "aggregatebykey", "reducebykey", "other")] == [
        "GroupByKey",
        "AggregateByKey",
        "ReduceByKey",
        "Unknown",
    ]


def test_top_pair_breaks_ties_by_pair_order(spark):
    counts = spark.createDataFrame(
        [(2.0, 1.0, 3.0, 1.0, 5), (1.0, 9.0, 3.0, 1.0, 5), (0.0, 0.0, 0.0, 1.0, 4)],
        "lat1 double, lon1 double, lat2 double, lon2 double, n long",
    )
    assert rows(top_pair(counts)) == [(1.0, 9.0, 3.0, 1.0, 5)]


def test_no_pairs(unique):
    lonely = unique.where("lat > 9")
    assert cooccurrences(lonely).count() == 0
    assert count_all_pairs(lonely).count() == 0
    assert cooccurrences(unique.where("false")).count() == 0
