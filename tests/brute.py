"""Plain Python answers for small inputs."""

from collections import Counter, defaultdict
from itertools import combinations


def instances(unique):
    """All (pair, day) rows of (lat, lon, date) rows, as sorted tuples."""
    by_day = defaultdict(set)
    for lat, lon, date in unique:
        by_day[date].add((lat, lon))
    return sorted(
        (*a, *b, date) for date, cells in by_day.items() for a, b in combinations(sorted(cells), 2)
    )


def counts(unique):
    return Counter(row[:4] for row in instances(unique))


def winner(unique):
    """(pair columns, n) or None; the smallest pair among equals."""
    counted = counts(unique)
    if not counted:
        return None
    pair, n = min(counted.items(), key=lambda item: (-item[1], item[0]))
    return (*pair, n)


def rows(df):
    return sorted(tuple(row) for row in df.collect())
