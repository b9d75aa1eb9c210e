"""A raw seismic text table derived from the ``events`` table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _degrees(thousandths):
    whole = F.expr(f"{thousandths} div 1000").cast("string")
    fraction = F.lpad((F.col(thousandths) % 1000).cast("string"), 3, "0")
    return F.concat(whole, F.lit("."), fraction)


def seismic_table(spark: SparkSession, folder: str) -> DataFrame:
    """event_id, latitude, longitude, date as text, with known dirty rows."""
    place = F.col("user_id") % 400
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return (
        spark.read.parquet(f"{folder}/events.parquet")
        .select(
            "event_id",
            (36000 + (place * 173) % 9000 + F.col("event_id") % 60).alias("lat_m"),
            (7000 + (place * 911) % 11000 + (F.col("event_id") * 7) % 60).alias("lon_m"),
            stamp.alias("stamp"),
        )
        .select(
            "event_id",
            F.when(F.col("event_id") % 97 == 0, "n/a").otherwise(_degrees("lat_m")).alias("latitude"),
            F.when(F.col("event_id") % 103 != 0, _degrees("lon_m")).alias("longitude"),
            F.when(F.col("event_id") % 101 == 0, F.substring("stamp", 1, 7))
            .otherwise(F.col("stamp"))
            .alias("date"),
        )
    )
