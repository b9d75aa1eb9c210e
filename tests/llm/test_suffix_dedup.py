import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from codays.llm.run_index import RunIndex, joined
from codays.llm.suffix_dedup import WINDOW, anchors, remove_repeats, repeated_spans

random.seed(2)


def some(letters, n):
    return "".join(random.choice(letters) for _ in range(n))


LONG, PASSAGE = some("abcdefgh ", 6000), some("xyzw ", 900)
ROWS = [
    (1, LONG),
    (2, LONG[:3000] + "#" + LONG[3001:]),
    (3, some("klm ", 500) + PASSAGE[:450] + some("klm ", 300)),
    (4, some("klm ", 200) + PASSAGE[:399] + some("klm ", 300)),
    (5, PASSAGE + some("klm ", 20)),
    (6, some("klm ", 50) + PASSAGE[:400]),
    (7, None),
    (8, ""),
    (9, "a" * 3000),
    (10, "ab" * 900),
    (11, some("klm ", 1000)),
    (None, some("klm ", 100) + LONG[100:600]),
    (12, LONG[100:499]),
    (13, "é" * 500),
    (1, LONG),
    (15, some("kl ", 300) + PASSAGE[100:520] + some("kl ", 100) + PASSAGE[100:520]),
    (16, PASSAGE[200:620] + "q" + PASSAGE[201:630]),
]


def brute(rows):
    seen = Counter()
    for _, text in rows:
        data = (text or "").encode()
        seen.update(data[i : i + WINDOW] for i in range(len(data) - WINDOW + 1))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - WINDOW + 1):
            if seen[data[i : i + WINDOW]] > 1:
                gone[i : i + WINDOW] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_removal_against_brute_force(spark):
    frame = spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, text string, key string")
    assert sorted(map(tuple, remove_repeats(frame).collect()), key=repr) == brute(ROWS)


def test_counting_windows_gives_the_same_as_the_index(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string")

    def spans(most_contexts):
        _, cuts = repeated_spans(frame, most_contexts)
        return sorted((bytes(r.key), r.removed) for r in cuts.collect())

    assert spans(1) == spans(20_000)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("seed", range(15))
def test_matching_statistics(seed):
    rng = np.random.default_rng(seed)
    text, _ = joined([rng.integers(0, 3, rng.integers(0, 20)) for _ in range(rng.integers(1, 6))])
    longest = RunIndex(text).matching_statistics()
    values = text.tolist()
    for i in range(len(values)):
        best = 0
        for j in range(len(values)):
            n = 0
            while i != j and max(i, j) + n < len(values) and values[i + n] == values[j + n]:
                n += 1
            best = max(best, n)
        assert best == longest[i]


def test_runs_shrink_on_repetitive_strings():
    one = np.random.default_rng(0).integers(0, 200, 300)
    index = RunIndex(joined([one] * 50)[0])
    assert len(index.run_lengths) < 0.05 * len(index.text)


def test_equal_windows_have_equal_anchors():
    data = (some("abc ", 700) + PASSAGE + some("abc ", 50) + PASSAGE[3:]).encode()
    at, _, first, last = anchors(data)
    anchor_of = {}
    for a, f, z in zip(at, first, last):
        for window in range(f, z + 1):
            place = anchor_of.setdefault(data[window : window + WINDOW], a - window)
            assert place == a - window
    assert sum(z - f + 1 for f, z in zip(first, last)) == len(data) - WINDOW + 1
