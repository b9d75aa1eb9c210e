"""Near-duplicate vectors, exact top k and components against brute force."""

import random

import numpy as np
import pytest

from codays.llm import pivots
from codays.llm.components import components
from codays.llm.pivots import near_duplicates
from codays.llm.top_k import SortedLists, quantised, top_k

ODD = [
    (90_000, None),
    (90_001, [0.0] * 16),
    (90_002, [float("nan")] * 16),
    (90_003, [None] * 16),
    (90_004, [1.0, 2.0]),
    (90_005, []),
    (90_006, [float("inf")] * 16),
    (None, [1.0] * 16),
]
SCHEMA = "vec_id long, embedding array<double>, node string, q int"


def near_vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 16))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    out = list(base)
    for centre, count, low in ((None, 150, 0.85), (7, 250, 0.93)):
        for i in range(count):
            own = base[i if centre is None else centre]
            c, n = rng.uniform(low, 0.999), rng.normal(size=16)
            n -= n @ own * own
            out.append(c * own + np.sqrt(1 - c * c) * n / np.linalg.norm(n))
    return [*out, *[base[3]] * 60]


def test_near_duplicates_against_brute_force(spark):
    vectors = near_vectors()
    rows = [(i, [float(x) for x in v], "a", 1) for i, v in enumerate(vectors)] + [(i, v, None, None) for i, v in ODD]
    got = {r.vec_id: r for r in near_duplicates(spark.createDataFrame(rows, SCHEMA), rows_per_block=128).collect()}
    assert len(got) == len(rows)
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    found = np.array([got[i].n_links for i in range(len(vectors))])
    assert (found <= linked.sum(1)).all()
    assert found.sum() >= 0.99 * linked.sum()
    for i in range(len(vectors)):
        reach, todo = {i}, [i]
        while todo:
            new = set(np.flatnonzero(linked[todo.pop()]).tolist()) - reach
            reach |= new
            todo += new
        if found[i] == linked[i].sum():
            assert got[i].component_id == min(reach)
            assert got[i].kept == (i == min(reach))
    for i, _ in ODD:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_links_in_a_dense_group_with_hundreds_of_pivots(spark, monkeypatch):
    rng = np.random.default_rng(8)
    n, width = 1500, 64
    vectors = rng.normal(size=(n, width))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    centre = vectors[0]
    for i in range(1, n // 3):
        noise = vectors[i] - (vectors[i] @ centre) * centre
        c = rng.uniform(0.95, 0.98)
        vectors[i] = c * centre + np.sqrt(1 - c * c) * noise / np.linalg.norm(noise)
    monkeypatch.setattr(pivots, "LEAST_PIVOTS", 900)
    rows = [(i, [float(x) for x in v], None, None) for i, v in enumerate(vectors)]
    got = {r.vec_id: r.n_links for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    linked = vectors @ vectors.T >= 0.9
    np.fill_diagonal(linked, False)
    assert sum(got.values()) >= 0.999 * linked.sum()


@pytest.mark.parametrize("common", [0.0, 0.5, 0.7])
def test_a_common_direction_leaves_lists_short(common):
    """Pivots stay many, lists short, and pairs that link are found, whatever all vectors share."""
    rng = np.random.default_rng(9)
    width, n = 64, 20_000
    direction = np.eye(width)[0]

    def drawn(k):
        own = rng.normal(size=(k, width))
        own[:, 0] = 0
        own /= np.linalg.norm(own, axis=1, keepdims=True)
        return common**0.5 * direction + (1 - common) ** 0.5 * own

    rows = drawn(n)
    own = rows[:141]
    centre = own.mean(axis=0)
    seen = pivots.about(own, centre)
    chosen = seen[pivots.thinned(seen, 0.9)]
    assert len(chosen) >= 70
    index = pivots.Pivots(centre, chosen, pivots.enough_named(own, centre, chosen, 0.9, 12, 2))
    named = pivots.named_pivots(rows, index)
    assert np.bincount(named.ravel()).max() < 0.2 * n
    partners = rows[:3000] + rng.uniform(0.2, 1.0, (3000, 1)) * (drawn(3000) - drawn(3000)) * 0.35
    partners /= np.linalg.norm(partners, axis=1, keepdims=True)
    linked = (partners * rows[:3000]).sum(1) >= 0.9
    other = pivots.named_pivots(partners, index)
    shared = (named[:3000, :, None] == other[:, None, :]).sum((1, 2)) >= 2
    assert linked.sum() > 500 and shared[linked].mean() >= 0.99


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = [*rng.normal(0, 0.1, (400, 16)), *[np.full(16, 0.25)] * 40]
    rows = [(i, [float(x) for x in v], None, None) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows + [(i, v, None, None) for i, v in ODD], SCHEMA)
    usable = quantised(frame)
    got = top_k(usable, usable.where("vec_id % 10 = 0"), 5, queries_per_block=16, candidates_per_block=150)
    whole = np.floor(256 * np.array(vectors)).astype(int)
    expected = []
    for query in range(0, len(vectors), 10):
        scores = sorted((-int(whole[query] @ whole[i]), i) for i in range(len(vectors)) if i != query)
        expected += [(query, n + 1, i, -s) for n, (s, i) in enumerate(scores[:5])]
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(empty).collect() == []
    assert top_k(quantised(empty), quantised(empty)).collect() == []


def test_reading_stops_with_all_winners_left():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-40, 40, (700, 12))
    lists = SortedLists(vectors)
    for query in rng.integers(-40, 40, (20, 12)):
        rows, scores = lists.best(query, 6)
        exact = np.sort(vectors @ query)[::-1][:6]
        assert (np.sort(scores)[::-1][:6] == exact).all()
        assert (vectors[rows] @ query == scores).all()


def test_bounds_of_many_queries_are_one_product(monkeypatch):
    """All queries of a block share the tables of a depth, and each gets its winners, small or huge."""
    rng = np.random.default_rng(3)
    made, shown = [], SortedLists._shown
    monkeypatch.setattr(SortedLists, "_shown", lambda *given: made.append(given[1:]) or shown(*given))
    for top in (2, 40, 2**28):
        vectors = np.vstack((rng.integers(-top, top, (900, 6)), np.full((200, 6), top // 2)))
        queries = rng.integers(-top, top, (600, 6))
        made.clear()
        answers = SortedLists(vectors).best_of_each(queries, 6)
        assert len(made) == len(set(made)) <= 8 and len(answers) == 600
        for query, (rows, scores) in zip(queries, answers):
            every = vectors @ query
            assert set(np.flatnonzero(every >= np.sort(every)[-6])) <= set(rows)
            assert (every[rows] == scores).all()
    assert SortedLists(vectors).best_of_each(queries[:0], 6) == []


def test_components(spark):
    random.seed(1)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(140)] + [(i, i + 1) for i in range(500, 560)]
    root = list(range(600))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame([*edges, (None, 4)], "x long, y long")).collect()
    assert {r.node for r in got} == {x for e in edges if e[0] != e[1] for x in e}
    assert all(find(r.node) == r.component for r in got)
