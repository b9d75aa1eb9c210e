"""Every registered query against its SQL, and the plans behind the main ones."""

import re

import duckdb
import pytest

import __spark_entry__ as registered

# The optional queries over texts and vectors have tests of their own.
OPTIONAL = {*registered.LLM_QUERIES, *registered.PIPELINE_QUERIES}
QUERIES = {name: query for name, query in registered.queries().items() if name not in OPTIONAL}
SQL = {name: sql for name, sql in registered.oracle_sql().items() if name not in OPTIONAL}


@pytest.fixture(scope="module")
def database(sf_small):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{sf_small}/events.parquet'")
    return connection


def in_order(columns, records):
    names = sorted(columns)
    order = [list(columns).index(name) for name in names]
    return names, sorted((tuple(record[i] for i in order) for record in records), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, database, sf_small, name):
    got = QUERIES[name](spark, sf_small)
    expected = database.execute(SQL[name])
    columns = [c[0] for c in expected.description]
    assert in_order(got.columns, map(tuple, got.collect())) == in_order(columns, expected.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["cooccurrences", "cooccurrences_array", "pair_counts_group", "pair_counts_reduce"])
def test_no_cross_join_and_no_python(spark, sf_small, name):
    plan = plan_of(QUERIES[name](spark, sf_small))
    assert not re.search("CartesianProduct|NestedLoopJoin|Python|ArrowEval", plan)


@pytest.mark.parametrize("name", ["pair_counts_group", "pair_counts_aggregate", "pair_counts_reduce"])
def test_pairs_are_counted_where_they_are_made(spark, sf_small, name):
    """From the top of the plan, the first shuffle is the one by tile, below the pairs."""
    plan = plan_of(QUERIES[name](spark, sf_small))
    above = plan[: plan.index("Exchange")]
    assert "Generate explode(seconds" in above
    assert re.match(r"Exchange \w+\(direct_shuffle_partition_id\(task", plan[plan.index("Exchange") :])


def test_block_pairs_are_never_broadcast(spark, sf_small):
    for name in ("cooccurrences", "cooccurrences_blocked"):
        plan = plan_of(QUERIES[name](spark, sf_small))
        assert re.search(r"SortMergeJoin \[date1#\d+, i1#\d+L?, j1#\d+L?\]", plan)


def test_scan_reads_only_the_columns_it_needs(spark, sf_small):
    plan = plan_of(QUERIES["unique_events"](spark, sf_small))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


def test_day_counts_form_no_pairs(spark, sf_small):
    for name in ("cells_per_day", "row_counts"):
        assert "Join" not in plan_of(QUERIES[name](spark, sf_small))
