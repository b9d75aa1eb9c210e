"""From raw event rows to the winning pair, as one row."""

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from codays.fixed_values import DEFAULT_STRATEGY
from codays.functions import PAIR, pair_label
from codays.operators.contenders import Winner, find_winner
from codays.operators.grid import cell_days, row_count_sums, sized_cell_days, with_day_sizes
from codays.operators.result import PREVIEW_ALL, PREVIEW_FEW, shared_days
from codays.session import staged

COUNTS = ["total_events", "unique_events", "co_occurrences"]


class Loaded(NamedTuple):
    """Staged (cell, day) rows with the sizes of their days, and the row counts of the whole table."""

    days: DataFrame
    counts: dict[str, int]

    def unique(self) -> DataFrame:
        return sized_cell_days(self.days)


def load(raw: DataFrame) -> Loaded:
    """The one pass over the raw rows; everything later reads what it staged.

    The row counts are observed in the tasks that write the table, each of which
    counts once however often executors are lost, so they cost no job.
    """
    seen = Observation("row counts")
    sums = [value.alias(name) for name, value in row_count_sums().items()]
    days = staged(with_day_sizes(cell_days(raw)).observe(seen, *sums), "cell-days")
    return Loaded(days, {name: int(n or 0) for name, n in seen.get.items()})


def load_cell_days(raw: DataFrame) -> DataFrame:
    """The staged rows of ``load`` alone."""
    return load(raw).days


def counts_row(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Row counts as one row."""
    return spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in counts.items()])


def winning_pair(
    days: DataFrame,
    strategy: str = DEFAULT_STRATEGY,
    num_partitions: int | None = None,
    search: str = "pruned",
) -> DataFrame:
    """The most frequent pair of ``load``'s rows as one row, or none."""
    return find_winner(sized_cell_days(days), strategy, num_partitions, search).frame(days.sparkSession)


def result_row(loaded: Loaded, winner: Winner) -> DataFrame:
    """The pair, its ordered days and the row counts, as exactly one row.

    Without a winner the pair is null, the days are empty and the count is 0.
    """
    pair = winner.pair
    # The collected list is the result itself: the days of one pair.
    days = shared_days(loaded.unique(), *pair[:4]) if pair else loaded.unique().select("date").limit(0)
    return days.agg(F.sort_array(F.collect_list("date")).alias("dates")).select(
        *[F.lit(getattr(pair, c, None)).cast("double").alias(c) for c in PAIR],
        F.lit(pair.n if pair else 0).cast("long").alias("max_count"),
        F.size("dates").alias("n_dates"),
        "dates",
        *[F.lit(loaded.counts[c]).cast("long").alias(c) for c in COUNTS],
    )


class Analysis(NamedTuple):
    """The result row, and the number of tasks that counted pairs."""

    result: DataFrame
    tasks: int


def analyse_loaded(
    loaded: Loaded,
    strategy: str = DEFAULT_STRATEGY,
    num_partitions: int | None = None,
    search: str = "pruned",
) -> Analysis:
    winner = find_winner(loaded.unique(), strategy, num_partitions, search)
    return Analysis(result_row(loaded, winner), winner.tasks)


def analyse(
    raw: DataFrame, strategy: str = DEFAULT_STRATEGY, num_partitions: int | None = None
) -> DataFrame:
    """The analysis end to end; ``raw`` has latitude, longitude and date as text."""
    return analyse_loaded(load(raw), strategy, num_partitions).result


def result_summary(result: DataFrame) -> DataFrame:
    """Counts, date range and a short list of days; no row without a winner."""
    dates, n = F.col("dates"), F.col("n_dates")
    short = n <= PREVIEW_ALL
    shown = F.when(short, dates).otherwise(F.slice(dates, 1, PREVIEW_FEW))
    return result.where(F.col("lat1").isNotNull()).select(
        *PAIR,
        "n_dates",
        *COUNTS,
        F.array_min(dates).alias("first_date"),
        F.array_max(dates).alias("last_date"),
        F.array_join(shown, ", ").alias("preview"),
        F.when(short, 0).otherwise(n - PREVIEW_FEW).alias("more_dates"),
    )


def result_text(result: DataFrame) -> DataFrame:
    """The pair on the first line, then one day per line; no row without a winner."""
    label = pair_label(*[F.col(c) for c in PAIR])
    return result.where(F.col("lat1").isNotNull()).select(
        F.concat_ws("\n", label, F.array_join("dates", "\n")).alias("value")
    )
