import random

import pytest

from codays.operators.contenders import (
    contender_counts,
    most_frequent_pair,
    opening,
    ranked_rows,
    shared_activity,
)
from codays.operators.result import top_pair_dates
from codays.session import staged

import brute
from brute import rows

UNIQUE = "lat double, lon double, date string"


def day(i):
    return f"{2000 + i // 360}-{i // 30 % 12 + 1:02d}-{i % 30 + 1:02d}"


def cell(i):
    return (float(i % 97), float(i // 97))


def uniform(rng):
    return {(*cell(rng.randrange(60)), day(rng.randrange(25))) for _ in range(400)}


def long_tail(rng):
    return {(*cell(int(rng.paretovariate(0.7)) % 300), day(int(rng.paretovariate(0.5)) % 80)) for _ in range(1500)}


def hot_day(rng):
    rest = {(*cell(rng.randrange(300)), day(1 + rng.randrange(100))) for _ in range(600)}
    return rest | {(*cell(i), day(0)) for i in range(300)}


def hot_cell(rng):
    rest = {(*cell(1 + rng.randrange(200)), day(rng.randrange(400))) for _ in range(800)}
    return rest | {(*cell(0), day(i)) for i in range(400)}


def single_day(rng):
    return {(*cell(i), day(0)) for i in range(400)}


def all_tied(rng):
    return {(*cell(i), day(d)) for i in range(40) for d in range(6)}


def no_pair_twice(rng):
    return {(*cell(i), day(i // 3)) for i in range(150)}


def copies(rng):
    rest = {(*cell(i), day(rng.randrange(60))) for i in range(200) for _ in range(6)}
    return rest | {(*cell(500 + i), day(d)) for i in range(80) for d in (3, 9, 40)}


def tie_far_from_the_seeds(rng):
    busy = {(*cell(1000 + i), day(d)) for i in range(40) for d in range(2)}
    early = {(*cell(i), day(10 + i // 2)) for i in range(20)} | {
        (*cell(i), day(30 + i // 2)) for i in range(20)
    }
    return busy | early


CASES = [uniform, long_tail, hot_day, hot_cell, single_day, all_tied, no_pair_twice, copies, tie_far_from_the_seeds]


@pytest.mark.parametrize("make", CASES, ids=lambda value: value.__name__)
def test_pruned_winner_equals_brute_force(spark, make, monkeypatch):
    """With days left aside wherever that forms fewer pairs, so that contenders are counted again."""
    monkeypatch.setattr("codays.operators.contenders.FREE_PAIRS", 0)
    data = make(random.Random(11))
    unique = staged(spark.createDataFrame(sorted(data), UNIQUE), "unique")
    kept = rows(contender_counts(unique, "3"))
    expected = brute.counts(data)
    assert min(kept, key=lambda row: (-row[4], row)) == brute.winner(data)
    assert all(expected[row[:4]] == row[4] for row in kept)
    assert len(kept) == len({row[:4] for row in kept})


@pytest.mark.parametrize("seed", range(2))
def test_pruned_winner_of_random_tables(spark, seed):
    rng = random.Random(seed)
    cells, days, n = rng.choice([8, 40, 200]), rng.choice([2, 12, 90]), rng.choice([60, 300, 900])
    data = {(*cell(int(rng.random() ** 2 * cells)), day(int(rng.random() ** 3 * days))) for _ in range(n)}
    unique = staged(spark.createDataFrame(sorted(data), UNIQUE), "unique")
    winner = brute.winner(data)
    assert rows(most_frequent_pair(unique)) == ([winner] if winner else [])


def test_a_floor_pair_last_in_order(spark):
    """The seeds find a pair that ties with one far before it."""
    late = {(*cell(2000 + i), day(d)) for i in range(40) for d in range(3)}
    early = {(*cell(i), day(200 + i // 2 * 3 + d)) for i in range(30) for d in range(3)}
    unique = staged(spark.createDataFrame(sorted(late | early), UNIQUE), "unique")
    assert rows(most_frequent_pair(unique)) == [brute.winner(late | early)]


@pytest.mark.parametrize("cells", [6, 3000])
def test_one_way_at_every_size(spark, monkeypatch, cells):
    """Tiny tables are searched like large ones; all pairs are counted on demand only."""

    def refused(*_):
        raise AssertionError("all pairs counted")

    monkeypatch.setattr("codays.operators.contenders.count_all_pairs", refused)
    spread = spark.range(cells * 8).selectExpr(
        f"double(id % {cells}) AS lat", "0D AS lon", "concat('2024-01-', lpad(id % 7, 2, '0')) AS date"
    )
    unique = staged(spread.distinct(), "unique")
    assert most_frequent_pair(unique).count() == 1
    with pytest.raises(AssertionError):
        most_frequent_pair(unique, search="all")


def test_too_few_seeds_are_refused(spark):
    unique = spark.createDataFrame(sorted(single_day(None)), UNIQUE)
    with pytest.raises(ValueError):
        opening(shared_activity(unique), seed_cells=1)


def test_a_crowded_day_is_not_expanded(spark):
    unique = spark.createDataFrame(sorted(single_day(None)), UNIQUE)
    assert contender_counts(unique).count() == 1


def test_slack_leaves_the_crowded_day_aside(spark):
    ranked = ranked_rows(shared_activity(spark.createDataFrame(sorted(hot_day(random.Random(2))), UNIQUE)), 2)
    assert ranked.where("later >= 1 and date = '2000-01-01'").count() == 0
    assert ranked.where("later >= 0 and date = '2000-01-01'").count() > 100


def test_both_ways_to_the_winner_agree(spark):
    data = long_tail(random.Random(3))
    unique = spark.createDataFrame(sorted(data), UNIQUE)
    for search, strategy in (("pruned", "1"), ("pruned", "2"), ("all", "1"), ("all", "3")):
        assert rows(most_frequent_pair(unique, strategy, 4, search)) == [brute.winner(data)]
    with pytest.raises(ValueError):
        most_frequent_pair(unique, search="some")


def test_opening_is_a_count_that_occurs(spark):
    data = uniform(random.Random(7))
    best = opening(shared_activity(spark.createDataFrame(sorted(data), UNIQUE)))
    assert brute.counts(data)[best[:4]] == best.n


def test_without_pairs(spark):
    lonely = spark.createDataFrame([(1.0, 1.0, day(0)), (2.0, 2.0, day(1))], UNIQUE)
    assert contender_counts(lonely).columns == ["lat1", "lon1", "lat2", "lon2", "n"]
    assert contender_counts(lonely).count() == 0
    for search in ("pruned", "all"):
        assert most_frequent_pair(lonely, search=search).count() == 0
        assert most_frequent_pair(lonely.where("false"), search=search).count() == 0


def test_winner_days(spark):
    data = hot_day(random.Random(2))
    unique = spark.createDataFrame(sorted(data), UNIQUE)
    top = most_frequent_pair(unique)
    pair = brute.winner(data)[:4]
    expected = sorted(r[4] for r in brute.instances(data) if r[:4] == pair)
    assert [r.date for r in top_pair_dates(unique, top).collect()] == expected
