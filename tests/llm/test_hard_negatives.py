"""Hard negatives against brute force."""

import numpy as np
import pytest

from codays.llm.hard_negatives import SubsetSums, bars, bit_planes, hard_negatives, mine, whole_vectors

SCHEMA = "vec_id long, embedding array<double>, label int, score string, first int, length string, q double"


def brute(rows, anchors, positives=5, negatives=3, shares=(50, 95)):
    out = []
    for anchor, own, vector in anchors:
        met = [(-int(np.dot(vector, v)), i, label) for i, label, v in rows if i != anchor and len(v) == len(vector)]
        best = sorted((s, i) for s, i, label in met if label == own)[:positives]
        for s, positive in best:
            fit = sorted((t, i) for t, i, label in met if label != own and shares[0] * -s <= 100 * -t <= shares[1] * -s)
            out += [(anchor, positive, n + 1, i, -s, -t) for n, (t, i) in enumerate(fit[:negatives])]
    return sorted(out)


def whole(vector):
    return np.array([int(np.floor(256 * x)) for x in vector], dtype=object)


@pytest.mark.parametrize("width, largest", [(64, 300), (13, 5), (1, 1), (8, 2**27), (70, 2**20)])
def test_scores_are_inner_products(width, largest):
    rng = np.random.default_rng(width)
    rows, anchors = rng.integers(-largest, largest + 1, (40, width)), rng.integers(-largest, largest + 1, (9, width))
    rows[0], anchors[0] = -largest, -largest
    bits = int(np.abs(rows).max()).bit_length() + 1
    scores = SubsetSums(anchors, bits).scores(bit_planes(rows, bits))
    assert (scores == rows @ anchors.T).all()


def made_rows():
    rng = np.random.default_rng(13)
    centres = rng.normal(size=(4, 16))
    rows = []
    for i in range(600):
        v = centres[i % 4] + rng.normal(0, 0.6, 16)
        rows.append((i, (v / np.linalg.norm(v)).tolist(), i % 3))
    same = rows[20][1]
    rows += [(1000 + i, same, i % 2) for i in range(40)]  # copies of one vector under two labels
    rows += [(1100 + i, [0.0] * 16, 1) for i in range(10)]
    rows += [(1150, [0.5, 0.25], 1), (1200, [0.5, 0.5], 1), (1201, [0.5, 0.2], 2), (1250, [0.1], 5), (1300, [], 1), (1302, [], 1)]
    return rows


def odd_rows():
    nan, inf = float("nan"), float("inf")
    fine = [1.0] * 16
    return [
        (1350, None, 1),
        (1400, fine, None),
        (None, fine, 1),
        (1450, [nan] + fine[1:], 1),
        (1500, [inf] + fine[1:], 1),
        (1550, [None] + fine[1:], 1),
    ]


def test_query_against_brute_force(spark):
    rows = made_rows()
    frame = spark.createDataFrame([(*r, "s", 1, "l", 0.5) for r in [*rows, *odd_rows(), rows[0]]], SCHEMA)
    moved = [(i, (label + 1) % 10 if i % 7 == 0 else label, whole(v)) for i, v, label in rows]
    expected = brute(moved, [r for r in moved if r[0] % 50 == 0])
    got = hard_negatives(frame)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == expected
    assert len(expected) > 50


def test_small_blocks_give_the_same(spark):
    rows = whole_vectors(spark.createDataFrame([(*r, "s", 1, "l", 0.5) for r in made_rows()], SCHEMA))
    given = [(i, label, whole(v)) for i, v, label in made_rows()]
    got = mine(rows, rows.where("vec_id % 20 = 0"), 2, 4, (10, 99), anchors_per_block=7, candidates_per_block=90)
    expected = brute(given, [r for r in given if r[0] % 20 == 0], 2, 4, (10, 99))
    assert sorted(map(tuple, got.collect())) == expected


def test_bars_of_any_sign():
    assert bars(100) == (50, 95)
    assert bars(101) == (51, 95)
    assert bars(0) == (0, 0)
    low, high = bars(-3)
    assert low > high


def test_components_beyond_64_bits_are_held(spark):
    rows = [(50, [1e30, -1e30], 1), (51, [1e30, 1.0], 1), (52, [1.0, 1.0], 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    most = int((2.0**62 / 2) ** 0.5)
    assert {r.vec_id: r.q for r in whole_vectors(frame).collect()}[50] == [most, -most]
    assert hard_negatives(frame).collect() == []


def test_empty_table(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []
