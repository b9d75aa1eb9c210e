"""The winning pair, its days and its labels."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codays.functions import PAIR, cell_label, pair_label

PREVIEW_ALL = 10
PREVIEW_FEW = 5


def top_pair(counts: DataFrame) -> DataFrame:
    """The pair with the largest count; the smallest pair among equals."""
    return counts.select(*PAIR, "n").orderBy(F.desc("n"), *PAIR).limit(1)


def with_labels(pairs: DataFrame) -> DataFrame:
    lat1, lon1, lat2, lon2 = [F.col(c) for c in PAIR]
    return pairs.withColumns(
        {
            "label1": cell_label(lat1, lon1),
            "label2": cell_label(lat2, lon2),
            "label": pair_label(lat1, lon1, lat2, lon2),
        }
    )


def shared_days(unique: DataFrame, lat1: float, lon1: float, lat2: float, lon2: float) -> DataFrame:
    """The days on which both cells are active; the scan gives rows of these cells only."""

    def at(lat: float, lon: float):
        return (F.col("lat") == F.lit(lat)) & (F.col("lon") == F.lit(lon))

    both = unique.where(at(lat1, lon1) | at(lat2, lon2))
    return both.groupBy("date").agg(F.count("*").alias("ends")).where("ends = 2").select("date")


def pair_days(unique: DataFrame, top: DataFrame) -> DataFrame:
    """The days on which both cells of the one-row ``top`` are active.

    Only rows of the two cells are looked at; no pair is formed again.
    """
    ends = top.select(
        *PAIR,
        "n",
        F.inline(
            F.array(
                F.struct(F.col("lat1").alias("lat"), F.col("lon1").alias("lon")),
                F.struct(F.col("lat2").alias("lat"), F.col("lon2").alias("lon")),
            )
        ),
    )
    # Two rows at most, so broadcasting them is safe at any scale.
    return (
        unique.join(F.broadcast(ends), ["lat", "lon"])
        .groupBy(*PAIR, "n", "date")
        .agg(F.count("*").alias("ends"))
        .where("ends = 2")
        .select(*PAIR, "n", "date")
    )


def top_pair_dates(unique: DataFrame, top: DataFrame) -> DataFrame:
    return pair_days(unique, top).select("date").orderBy("date")
