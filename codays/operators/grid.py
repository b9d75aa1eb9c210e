"""Grid cells, unique (cell, day) rows and row counts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codays.functions import to_grid
from codays.operators.clean import typed_events


def grid_cells(events: DataFrame) -> DataFrame:
    """Parsed events with their coordinates snapped to cells."""
    rest = [c for c in events.columns if c not in ("latitude", "longitude", "date")]
    return events.select(
        *rest,
        to_grid(F.col("latitude")).alias("lat"),
        to_grid(F.col("longitude")).alias("lon"),
        "date",
    )


def unique_events(cells: DataFrame) -> DataFrame:
    """One row per cell and day; duplicates fold before the shuffle."""
    return cells.select("lat", "lon", "date").distinct()


def cell_days(raw: DataFrame) -> DataFrame:
    """One row per cell and day with its numbers of raw and valid rows, in one pass.

    All rejected rows share the null key, so raw, valid and unique counts
    all follow from this one aggregate. Map-side combining keeps a cell, a day
    or a reject group that holds much of the input from crowding one task.
    """
    cells = grid_cells(typed_events(raw))
    valid = F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("date").isNotNull()
    return (
        cells.select(*[F.when(valid, F.col(c)).alias(c) for c in ("lat", "lon", "date")])
        .groupBy("lat", "lon", "date")
        .agg(F.count("*").alias("n_rows"), F.count("date").alias("n_valid"))
    )


def with_day_sizes(days: DataFrame) -> DataFrame:
    """``cell_days`` with ``n_cells``, the number of cells on the row's day.

    The sizes look at both counts, and dates are matched with nulls as equals, so
    that the sizes need the very aggregate that the rows need: its shuffle, and the
    scan below it, is done once for both.
    """
    there = (F.col("n_rows") > 0) & (F.col("n_valid") > 0)
    sizes = days.groupBy("date").agg(F.count_if(there).alias("n_cells")).withColumnRenamed("date", "day")
    return days.join(sizes, F.equal_null("date", "day"), "left").select(
        "lat", "lon", "date", "n_rows", "n_valid", "n_cells"
    )


def valid_cell_days(days: DataFrame) -> DataFrame:
    """The unique (cell, day) rows of ``cell_days``.

    Filtering on a count keeps the filter above the aggregate; one on the key
    would be pushed down and parse every raw row a second time.
    """
    return days.where("n_valid > 0").select("lat", "lon", "date")


def sized_cell_days(days: DataFrame) -> DataFrame:
    """``valid_cell_days`` of rows from ``with_day_sizes``, with the sizes."""
    return days.where("n_valid > 0").select("lat", "lon", "date", "n_cells")


def row_count_sums() -> dict[str, Column]:
    """The numbers of ``row_counts`` as sums over the rows of ``with_day_sizes``.

    A cell meets all others of its day, so pairs are half the sum over cells.
    """
    valid = F.col("n_valid") > 0

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")

    return {
        "raw_rows": total(F.col("n_rows")),
        "valid_rows": total(F.col("n_valid")),
        "total_events": total(F.col("n_valid")),
        "unique_events": F.count_if(valid),
        "co_occurrences": F.shiftright(total(F.when(valid, F.col("n_cells") - 1)), 1),
    }


def cells_per_day(unique: DataFrame) -> DataFrame:
    """Number of cells and of cell pairs on each day; no pair is formed."""
    n = F.col("n_cells")
    return (
        unique.groupBy("date")
        .agg(F.count("*").alias("n_cells"))
        .withColumn("n_pairs", F.expr("n_cells * (n_cells - 1) div 2"))
        .select("date", n, "n_pairs")
    )


def row_counts(days: DataFrame) -> DataFrame:
    """Raw, valid, total, unique and co-occurrence counts from ``cell_days``."""
    per_day = days.groupBy("date").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_valid").alias("n_valid"),
        F.count_if(F.col("n_valid") > 0).alias("n_cells"),
    )

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")

    return per_day.agg(
        total(F.col("n_rows")).alias("raw_rows"),
        total(F.col("n_valid")).alias("valid_rows"),
        total(F.col("n_valid")).alias("total_events"),
        total(F.col("n_cells")).alias("unique_events"),
        total(F.expr("n_cells * (n_cells - 1) div 2")).alias("co_occurrences"),
    )


def repartitioned(unique: DataFrame, num_partitions: int, *keys: str) -> DataFrame:
    """Spread rows over ``num_partitions``: round robin, or by hash of ``keys``."""
    return unique.repartition(num_partitions, *keys)
