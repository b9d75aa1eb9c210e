"""Lenient parsing of raw event rows."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codays.fixed_values import DAY_KEY_LENGTH, EVENT_COLUMNS
from codays.functions import as_number, day_key, finite
from codays.session import staged


def typed_columns() -> dict[str, Column]:
    """The event columns typed, in one step each."""
    return {
        "latitude": finite(as_number(F.col("latitude"))),
        "longitude": finite(as_number(F.col("longitude"))),
        "date": day_key(F.col("date")),
    }


def typed_events(raw: DataFrame) -> DataFrame:
    """Every raw row with typed columns, null where a value is unusable.

    Two projections, so that each text is parsed once and then checked.
    """
    latitude, longitude, date = [F.col(c) for c in EVENT_COLUMNS]
    numbers = raw.withColumns(
        {"latitude": as_number(latitude), "longitude": as_number(longitude), "date": day_key(date)}
    )
    return numbers.withColumns({"latitude": finite(latitude), "longitude": finite(longitude)})


def parse_events(raw: DataFrame) -> DataFrame:
    """Typed rows; a row is kept when both numbers and the day are present."""
    return typed_events(raw).dropna(subset=list(EVENT_COLUMNS))


def _number_fault(name: str) -> Column:
    text = F.col(name)
    return (
        F.when(text.isNull() | (text == ""), f"{name} missing")
        .when(as_number(text).isNull(), f"{name} not a number")
        .when(finite(as_number(text)).isNull(), f"{name} not finite")
    )


def _fault() -> Column:
    """The first fault of a row that ``parse_events`` drops, null for any other."""
    date = F.col("date")
    date_fault = F.when(date.isNull() | (date == ""), "date missing").when(
        F.length(date) < DAY_KEY_LENGTH, "date too short"
    )
    return F.coalesce(_number_fault("latitude"), _number_fault("longitude"), date_fault)


def rejects(raw: DataFrame) -> DataFrame:
    """Rows that ``parse_events`` drops, with the first fault found in each."""
    return raw.withColumn("reason", _fault()).where(F.col("reason").isNotNull())


class Split(NamedTuple):
    """Typed events, and rejected rows with their reason, from one staged table."""

    events: DataFrame
    rejects: DataFrame


def split_rejects(raw: DataFrame) -> Split:
    """Part the rows of ``load_event_files`` in one pass over the files.

    Both parts are written together, in folders by whether a row was rejected:
    valid rows with their typed columns, rejected ones with file, record and reason.
    """
    kept = F.col("reason").isNull()
    parted = raw.withColumn("reason", _fault()).select(
        *[F.when(kept, typed).alias(name) for name, typed in typed_columns().items()],
        "file",
        F.when(~kept, F.col("record")).alias("record"),
        "reason",
        (~kept).alias("rejected"),
    )
    table = staged(parted, "events", "rejected")
    return Split(
        table.where("not rejected").select(*EVENT_COLUMNS, "file"),
        table.where("rejected").select("file", "record", "reason"),
    )


def reject_audit(raw: DataFrame) -> DataFrame:
    return rejects(raw).groupBy("reason").agg(F.count("*").alias("n"))
