"""The most frequent pair, found exactly without forming every pair.

The days two cells share are the intersection of their day sets. Once some
pair is known to share ``floor`` days, only pairs sharing more (or as many, if
they come first in pair order) are of interest, and set-similarity pruning
applies:

* a cell with too few days is out;
* put all days in one order from quiet to crowded, and let ``later`` be how
  many of its own days a cell still has from a row on, not counting that row.
  Of ``t`` days that two cells share, the first ``t - slack`` are on rows with
  ``later >= slack`` for both cells. So pairs are counted on those rows alone,
  and a pair with fewer than ``t - slack`` of them is out. The rows left aside
  are those on the most crowded days, which make nearly all of the pairs;
* what remains is counted in full, by the common bits of the cells' day bitmaps.

More slack forms fewer pairs and leaves more of them to count again, so the
least slack is taken that forms at most ``ENOUGH`` times as many pairs as the
fewest possible, and ``FREE_PAIRS`` more. Without slack the counts are full ones
already. That, like every other step, is the same at every size.

Days are ordered by bands, not one by one: that keeps the running sums per
cell to a fixed number of bands whatever a cell's number of days, and only
makes ``later`` larger, which keeps more rows than needed but loses none.
"""

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from codays.fixed_values import DEFAULT_STRATEGY
from codays.functions import CELL, PAIR, precedes
from codays.operators.counts import TILE, count_all_pairs, pair_counts
from codays.operators.pairs import (
    PAIRS_PER_TASK,
    number_of_pairs,
    rectangular_cooccurrences,
    tasks_for,
    tiled_cooccurrences,
)
from codays.operators.result import top_pair
from codays.session import staged

#: Cells that the search opens with.
SEED_CELLS = 16
BANDS_PER_LEVEL = 64
ENOUGH = 2
#: As many pairs as one task forms cost less than counting any again.
FREE_PAIRS = PAIRS_PER_TASK
DAYS = ("n_days",)
BOTH_DAYS = ("n_days1", "n_days2")
COUNT_SCHEMA = "lat1 double, lon1 double, lat2 double, lon2 double, n bigint"


class Known(NamedTuple):
    """A pair and the number of days it is known to share."""

    lat1: float
    lon1: float
    lat2: float
    lon2: float
    n: int


def shared_activity(unique: DataFrame) -> DataFrame:
    """Rows on days with at least two cells: CELL, date, n_cells, n_days, later.

    n_cells: cells on that day, taken from ``unique`` where it has them; n_days:
    such days of that cell; later: how many of them are in later bands, plus those
    of the row's own band but one.
    """
    if "n_cells" in unique.columns:
        shared = unique.where("n_cells > 1")
    else:
        days = unique.groupBy("date").agg(F.count("*").alias("n_cells")).where("n_cells > 1")
        shared = unique.join(days, "date")
    level = F.floor(F.log2("n_cells")) * BANDS_PER_LEVEL
    rows = shared.withColumn("band", level + F.pmod(F.xxhash64("date"), F.lit(BANDS_PER_LEVEL)))
    sizes = rows.groupBy(*CELL, "band").agg(F.count("*").alias("k"))
    own = Window.partitionBy(*CELL)
    before = own.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = sizes.select(
        *CELL, "band", F.sum("k").over(own).alias("n_days"), F.coalesce(F.sum("k").over(before), F.lit(0)).alias("earlier")
    )
    later = (F.col("n_days") - F.col("earlier") - 1).alias("later")
    return rows.join(bands, [*CELL, "band"]).select(*CELL, "date", "n_cells", "n_days", later)


def ranked_rows(activity: DataFrame, floor: int) -> DataFrame:
    """Rows of cells with at least ``floor`` days."""
    return activity.where(F.col("n_days") >= floor)


def seed_metrics(seed_cells: int = SEED_CELLS) -> list[Column]:
    """Aggregates over ``shared_activity`` that name a very active cell each.

    Cells fall into as many classes by hash; the seed of a class is its cell with
    the most days, the first in cell order among equals.
    """
    if seed_cells < 2:
        raise ValueError("fewer than two seed cells share no day")
    best = F.struct("n_days", -F.col("lat"), -F.col("lon"))
    own = F.pmod(F.xxhash64("lat", "lon", F.lit(2)), F.lit(seed_cells))
    return [F.max(F.when(own == k, best)).alias(f"seed{k}") for k in range(seed_cells)]


def opening(activity: DataFrame, seed_cells: int = SEED_CELLS, metrics: dict | None = None) -> Known | None:
    """A floor for the maximum: the best pair among a few seed cells, if any two of them share a day.

    ``metrics`` has the values of ``seed_metrics`` where they are known.
    """
    named = metrics or activity.agg(*seed_metrics(seed_cells)).first().asDict()
    seeds = [seed for name, seed in sorted(named.items()) if name.startswith("seed") and seed is not None]
    if len(seeds) < 2:
        return None
    cells = [F.struct(F.lit(0.0 - seed[1]).alias("lat"), F.lit(0.0 - seed[2]).alias("lon")) for seed in seeds]
    # An array holds seeds alone.
    days = activity.where(F.struct(*CELL).isin(*cells)).groupBy("date").agg(F.collect_list(F.struct(*CELL)).alias("firsts"))
    met = days.withColumn("seconds", F.col("firsts")).select("date", F.explode("firsts").alias("a"), "seconds")
    met = met.select("date", "a", F.explode("seconds").alias("b"))
    ends = [F.col(f"{end}.{c}").alias(f"{c}{n}") for n, end in ((1, "a"), (2, "b")) for c in CELL]
    pairs = met.select(*ends, "date").where(precedes(*[F.col(c) for c in PAIR]))
    best = top_pair(pair_counts(pairs, "reducebykey")).first()
    return None if best is None else Known(*best)


def first_pair(activity: DataFrame) -> DataFrame:
    """The first of all pairs in pair order, from the two first cells of each day."""
    cell = F.struct(*CELL)
    firsts = activity.groupBy("date").agg(F.min(cell).alias("a"))
    seconds = (
        activity.join(firsts, "date")
        .where(cell > F.col("a"))
        .groupBy("date", "a")
        .agg(F.min(cell).alias("b"))
    )
    return (
        seconds.orderBy("a", "b")
        .limit(1)
        .select(
            F.col("a.lat").alias("lat1"),
            F.col("a.lon").alias("lon1"),
            F.col("b.lat").alias("lat2"),
            F.col("b.lon").alias("lon2"),
        )
    )


class Slack(NamedTuple):
    """How many days to leave aside, and the number of pairs that are formed then."""

    days: int
    pairs: int


def least_slacks(rows: DataFrame, searches: list[tuple[int, Column, Column | None]]) -> list[Slack]:
    """For each search the least slack that forms at most ``ENOUGH`` times the fewest pairs and ``FREE_PAIRS`` more.

    A search is (the most slack, which rows take part, which of them are on the
    left). Without a left side rows join each other, else left ones join all.
    Numbers of pairs follow from rows per day, in one job for all searches.
    """
    sizes, meetings, tried = [], [], []
    for at, (most, part, left) in enumerate(searches):
        slacks = sorted({0, most, *(2**k for k in range(most.bit_length()) if 2**k < most)})
        tried.append(slacks)
        for s in slacks:
            kept = part & (F.col("later") >= s)
            sizes.append(F.count_if(kept).alias(f"m{at}_{s}"))
            if left is None:
                meetings.append(F.expr(f"double(m{at}_{s}) * (m{at}_{s} - 1) / 2"))
            else:
                sizes.append(F.count_if(kept & left).alias(f"l{at}_{s}"))
                meetings.append(F.expr(f"double(l{at}_{s}) * m{at}_{s}"))
    per_day = rows.groupBy("date").agg(*sizes)
    costs = iter([cost or 0 for cost in per_day.agg(*map(F.sum, meetings)).first()])
    chosen = []
    for slacks in tried:
        own = [next(costs) for _ in slacks]
        chosen.append(next(Slack(s, int(cost)) for s, cost in zip(slacks, own) if cost <= ENOUGH * own[-1] + FREE_PAIRS))
    return chosen


#: Dates that end in such a number share a bitmap with others of their beginning.
IN_WORD = "right(date, 2) rlike '^([0-5][0-9]|6[0-2])$'"


def day_bitmaps(rows: DataFrame) -> DataFrame:
    """CELL, word, bits: the days of a cell, those of a month as the bits of one number.

    A date that ends in a number from 00 to 62 is the bit of that number in the
    word of what comes before; any other date is a word of its own, with bit 63.
    So different dates never share a bit, whatever their text, and no days need
    to be numbered.
    """
    word = F.expr(f"if({IN_WORD}, left(date, length(date) - 2), date)")
    bit = F.expr(f"shiftleft(1L, if({IN_WORD}, try_cast(right(date, 2) AS int), 63))")
    placed = rows.select(*CELL, word.alias("word"), bit.alias("bit"))
    return placed.groupBy(*CELL, "word").agg(F.bit_or("bit").alias("bits"))


def _shared() -> Column:
    return F.bit_count(F.col("bits").bitwiseAND(F.col("other_bits"))).cast("long")


def full_counts(pairs: DataFrame, rows: DataFrame, strategy: str) -> DataFrame:
    """The days that each of ``pairs`` shares; they carry n_days1 and n_days2.

    Walks the bitmaps of the cell that has fewer days and looks up the other,
    so a cell that is in very many pairs is mostly the one looked up. Between
    cells with equally many, a hash of the pair decides, so that pairs of a cell
    are walked from either end.
    """
    by_chance = F.pmod(F.xxhash64(*PAIR), F.lit(2)) == 0
    one_fewer = (F.col("n_days1") < F.col("n_days2")) | ((F.col("n_days1") == F.col("n_days2")) & by_chance)

    def end(name: str, first: bool) -> Column:
        one, two = F.col(f"{name}1"), F.col(f"{name}2")
        return F.when(one_fewer, one).otherwise(two) if first else F.when(one_fewer, two).otherwise(one)

    walk = pairs.select(
        *PAIR,
        *[end(c, True).alias(c) for c in CELL],
        *[end(c, False).alias(f"other_{c}") for c in CELL],
    )
    words = day_bitmaps(rows)
    others = words.toDF("other_lat", "other_lon", "word", "other_bits")
    met = walk.join(words, CELL).join(others, ["other_lat", "other_lon", "word"])
    gathered = met.select(*PAIR, "word", _shared().alias("k")).repartition(*PAIR)
    return pair_counts(gathered, strategy, part="word", weight="k")


def counts_above(
    activity: DataFrame, floor: int, slack: Slack, strategy: str, num_partitions: int | None = None
) -> DataFrame:
    """Counts of all pairs that share more than ``floor`` days."""
    able = ranked_rows(activity, floor + 1)
    quiet = able.where(F.col("later") >= slack.days)
    tiled = tiled_cooccurrences(quiet, num_partitions, carry=DAYS, pairs=slack.pairs)
    if not slack.days:
        return pair_counts(tiled, strategy, TILE).where(F.col("n") > floor)
    likely = pair_counts(tiled, "reducebykey", TILE, BOTH_DAYS).where(F.col("n") > floor - slack.days)
    return full_counts(likely, able, strategy).where(F.col("n") > floor)


def _up_to_first(known: Known) -> Column:
    return ~precedes(F.lit(known.lat1), F.lit(known.lon1), F.col("lat"), F.col("lon"))


def counts_at(
    activity: DataFrame, known: Known, slack: Slack, strategy: str, num_partitions: int | None = None
) -> DataFrame:
    """Counts of pairs up to ``known`` in pair order that share at least as many days.

    Rows of the cells up to the known first cell meet all rows.
    """
    first, second = (F.lit(known.lat1), F.lit(known.lon1)), (F.lit(known.lat2), F.lit(known.lon2))
    lat1, lon1, lat2, lon2 = [F.col(c) for c in PAIR]
    ranked = ranked_rows(activity, known.n)
    rows = ranked.where(F.col("later") >= slack.days)
    met = rectangular_cooccurrences(rows.where(_up_to_first(known)), rows, slack.pairs, num_partitions, carry=DAYS)
    not_after = precedes(lat1, lon1, *first) | ~precedes(*second, lat2, lon2)
    if not slack.days:
        return pair_counts(met.where(not_after), strategy, TILE).where(F.col("n") >= known.n)
    likely = pair_counts(met.where(not_after), "reducebykey", TILE, BOTH_DAYS).where(
        F.col("n") >= known.n - slack.days
    )
    return full_counts(likely, ranked, strategy).where(F.col("n") >= known.n)


class Search(NamedTuple):
    """Counts of pairs that may be the most frequent one, and the tasks that count them."""

    counts: DataFrame
    tasks: int


def searches(
    unique: DataFrame, strategy: str = DEFAULT_STRATEGY, num_partitions: int | None = None
) -> Iterator[Search]:
    """Searches for the most frequent pair, in order; the first with any counts has it.

    Their counts are complete, and a subset of ``count_all_pairs``. The steps are
    pairs above the opening floor, and then either no pair with a second day or a
    tie with the floor.
    """
    spark = unique.sparkSession
    seen = Observation("activity")
    activity = staged(
        shared_activity(unique).observe(seen, F.max("n_days").alias("most"), *seed_metrics()), "activity"
    )
    most = seen.get["most"]
    if most is None:
        return  # no two cells meet
    known = opening(activity, metrics=seen.get)
    # Two cells share a day, whether the seeds found one or not.
    floor = known.n if known else 1
    ways = []
    if most > floor:
        ways.append((floor, F.col("n_days") > floor, None))
    if floor > 1:
        ways.append((floor - 1, F.col("n_days") >= floor, _up_to_first(known)))
    slacks = least_slacks(activity, ways) if ways else []
    if most > floor:
        slack = slacks.pop(0)
        yield Search(
            counts_above(activity, floor, slack, strategy, num_partitions), tasks_for(spark, slack.pairs, num_partitions)
        )
    if floor > 1:
        slack = slacks.pop()
        yield Search(
            counts_at(activity, known, slack, strategy, num_partitions), tasks_for(spark, slack.pairs, num_partitions)
        )
    else:
        # No pair has a second day, so the first of all pairs is the winner.
        first = first_pair(activity).withColumn("n", F.lit(1).cast("long"))
        yield Search(first, tasks_for(spark, 0, num_partitions))


def contender_counts(
    unique: DataFrame, strategy: str = DEFAULT_STRATEGY, num_partitions: int | None = None
) -> DataFrame:
    """Full counts of the pairs that may be the most frequent one.

    A subset of ``count_all_pairs`` that always holds the pair with the most
    days, first in pair order among equals.
    """
    for search in searches(unique, strategy, num_partitions):
        counts = staged(search.counts, "contenders")
        if not counts.isEmpty():
            return counts
    return unique.sparkSession.createDataFrame([], COUNT_SCHEMA)


class Winner(NamedTuple):
    """The pair that shares the most days, if any two cells share one, and the tasks that counted it."""

    pair: Known | None
    tasks: int

    def frame(self, spark: SparkSession) -> DataFrame:
        """The pair as one row, or none."""
        if self.pair is None:
            return spark.createDataFrame([], COUNT_SCHEMA)
        values = [F.lit(float(v)) for v in self.pair[:4]] + [F.lit(self.pair.n).cast("long")]
        return spark.range(1).select(*[v.alias(c) for v, c in zip(values, Known._fields)])


def find_winner(
    unique: DataFrame,
    strategy: str = DEFAULT_STRATEGY,
    num_partitions: int | None = None,
    search: str = "pruned",
) -> Winner:
    """The most frequent pair.

    ``search`` is "pruned", or "all" to form and count every pair. Both find the
    same pair, and neither is chosen by size. ``unique`` is read several times and
    should be a staged table. What comes to the driver is one row for each step.
    """
    spark = unique.sparkSession
    if search == "all":
        pairs = number_of_pairs(unique)
        tried = iter([Search(count_all_pairs(unique, strategy, num_partitions, pairs), tasks_for(spark, pairs, num_partitions))])
    elif search == "pruned":
        tried = searches(unique, strategy, num_partitions)
    else:
        raise ValueError(f"unknown search {search!r}")
    tasks = tasks_for(spark, 0, num_partitions)
    for counts, tasks in tried:
        best = top_pair(counts).first()
        if best is not None:
            return Winner(Known(*best), tasks)
    return Winner(None, tasks)


def most_frequent_pair(
    unique: DataFrame,
    strategy: str = DEFAULT_STRATEGY,
    num_partitions: int | None = None,
    search: str = "pruned",
) -> DataFrame:
    """The pair that shares the most days, as one row or none; see ``find_winner``."""
    return find_winner(unique, strategy, num_partitions, search).frame(unique.sparkSession)
