"""Days per pair, with three interchangeable strategies."""

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codays.fixed_values import (
    DEFAULT_STRATEGY,
    STRATEGY_NAMES,
    STRATEGY_NUMBERS,
    UNKNOWN_STRATEGY_NAME,
)
from codays.functions import PAIR
from codays.operators.pairs import tiled_cooccurrences

DATE_BUCKETS = 4
TILE = ("task", "i", "j")


def parse_strategy(text: str) -> str:
    """A strategy from its name in any case or its number; unknown text warns."""
    key = text.lower()
    key = STRATEGY_NUMBERS.get(key, key)
    if key not in STRATEGY_NAMES:
        warnings.warn(f"unknown strategy {text!r}, using {DEFAULT_STRATEGY}", stacklevel=2)
        return DEFAULT_STRATEGY
    return key


def strategy_name(strategy: str) -> str:
    return STRATEGY_NAMES.get(strategy, UNKNOWN_STRATEGY_NAME)


def pair_counts(
    instances: DataFrame,
    strategy: str = DEFAULT_STRATEGY,
    within: tuple[str, ...] = (),
    carry: tuple[str, ...] = (),
    part: str = "date",
    weight: str | None = None,
) -> DataFrame:
    """Number of rows, or sum of ``weight``, per pair, with ``carry`` columns that the pair determines.

    ``within`` names columns that a pair determines and that the rows are
    already partitioned by; grouping by them as well saves the shuffle.

    * groupbykey: collect the partial counts of each pair, then sum the list;
      partial counts are per bucket of ``part``, so the list is short for any pair.
    * aggregatebykey: fold rows into a count per bucket, combine by sum.
    * reducebykey: one count with partial aggregation.
    """
    strategy = parse_strategy(strategy)
    number = F.sum(weight) if weight else F.count("*")
    keys, kept = [*within, *PAIR, *carry], [*PAIR, *carry]
    if strategy == "reducebykey":
        counted = instances.groupBy(*keys).agg(number.alias("n"))
        return counted.select(*kept, "n")

    bucket = F.pmod(F.xxhash64(part), F.lit(DATE_BUCKETS)).alias("bucket")
    partial = instances.groupBy(*keys, bucket).agg(number.alias("k"))
    if strategy == "aggregatebykey":
        return partial.groupBy(*keys).agg(F.sum("k").alias("n")).select(*kept, "n")
    listed = partial.groupBy(*keys).agg(F.collect_list("k").alias("ks"))
    added = F.aggregate("ks", F.lit(0).cast("long"), lambda total, k: total + k)
    return listed.select(*kept, added.alias("n"))


def count_all_pairs(
    unique: DataFrame,
    strategy: str = DEFAULT_STRATEGY,
    num_partitions: int | None = None,
    pairs: int | None = None,
) -> DataFrame:
    """Days per pair for every pair of cells that shares a day; ``pairs`` is their number, if known."""
    tiled = tiled_cooccurrences(unique, num_partitions, pairs=pairs)
    return pair_counts(tiled, strategy, within=TILE)
