"""Folds over the days of a pair, with their steps as parameters."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codays.functions import PAIR
from codays.operators.counts import TILE
from codays.operators.pairs import tiled_cooccurrences


class Fold(NamedTuple):
    """A start, a step that takes in one value, and a step that joins two results.

    ``seq`` and ``comb`` must not depend on the order in which values and results
    come, and ``comb`` must give the same however values were parted. All three
    have one type.
    """

    zero: Callable[[], Column]
    seq: Callable[[Column, Column], Column]
    comb: Callable[[Column, Column], Column]


#: The first and the last day of a pair, and their number.
FIRST_DAY = Fold(lambda: F.lit(None).cast("string"), F.least, F.least)
LAST_DAY = Fold(lambda: F.lit(None).cast("string"), F.greatest, F.greatest)
N_DAYS = Fold(lambda: F.lit(0).cast("long"), lambda n, _: n + 1, lambda n, m: n + m)


def month_of(date: str = "date") -> Column:
    return F.substring(date, 1, 7)


def fold_pairs(
    instances: DataFrame,
    folds: dict[str, Fold],
    value: str = "date",
    part: Column | None = None,
    within: tuple[str, ...] = (),
) -> DataFrame:
    """One row per pair with a column for each of ``folds`` over its ``value``s, all in one pass.

    Two levels: values of a pair are folded by ``seq`` within each ``part``, by
    default the month, and the results of the parts by ``comb``. So the first
    level holds a month of values at a time and the second one value per month.
    ``within`` is as in ``pair_counts``: where the rows are partitioned by it, no
    pair is shuffled.
    """
    keys = [*within, *PAIR]
    start = F.struct(*[fold.zero().alias(name) for name, fold in folds.items()])

    def step(which: int) -> Callable[[Column, Column], Column]:
        def both(held: Column, new: Column) -> Column:
            own = lambda name: new[name] if which else new
            return F.struct(*[(fold.seq, fold.comb)[which](held[name], own(name)).alias(name) for name, fold in folds.items()])

        return both

    parted = instances.groupBy(*keys, (month_of() if part is None else part).alias("part"))
    partial = parted.agg(F.collect_list(value).alias("values")).select(
        *keys, F.aggregate("values", start, step(0)).alias("result")
    )
    whole = partial.groupBy(*keys).agg(F.collect_list("result").alias("results"))
    return whole.select(*PAIR, F.aggregate("results", start, step(1)).alias("result")).select(
        *PAIR, *[F.col(f"result.{name}").alias(name) for name in folds]
    )


def pair_spans(unique: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """first_day, last_day and n_days of every pair of cells that shares a day."""
    folds = {"first_day": FIRST_DAY, "last_day": LAST_DAY, "n_days": N_DAYS}
    return fold_pairs(tiled_cooccurrences(unique, num_partitions), folds, within=TILE)
