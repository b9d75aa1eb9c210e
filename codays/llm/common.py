"""Helpers that several operators share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but blank, tab, line feed, VT, FF and CR.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ids_and_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that no other column can clash."""
    return docs.select(F.col("doc_id"), text_of().alias("text"))


def remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    key = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(F.encode(key, "utf-8")) % modulus


def whole_row(docs: DataFrame) -> Column:
    """All columns as one named ``row``, so that columns beside it cannot clash; ``select("row.*")`` undoes it."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
