"""Column functions shared by the operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from codays.fixed_values import DAY_KEY_LENGTH

CELL = ["lat", "lon"]
PAIR = ["lat1", "lon1", "lat2", "lon2"]


def as_number(text: Column) -> Column:
    """Text as a double, with blanks, suffixes and hex forms; null for other text."""
    return text.try_cast("double")


def finite(number: Column) -> Column:
    """The number itself; null for NaN and the infinities."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def day_key(text: Column) -> Column:
    """The leading ten characters, with no calendar check; null when shorter."""
    return F.when(F.length(text) >= DAY_KEY_LENGTH, F.substring(text, 1, DAY_KEY_LENGTH))


def to_grid(degrees: Column) -> Column:
    """One decimal, halves away from zero."""
    return F.round(degrees, 1)


def precedes(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Cell order: latitude first, then longitude."""
    return (lat1 < lat2) | ((lat1 == lat2) & (lon1 < lon2))


def ordered_pair(
    lat1: Column, lon1: Column, lat2: Column, lon2: Column, carry: tuple[str, ...] = ()
) -> list[Column]:
    """The four pair columns with the smaller cell first; equal cells are allowed.

    ``carry`` columns, suffixed 1 and 2 like the cells, follow their cell.
    """
    swap = precedes(lat2, lon2, lat1, lon1)
    sides = [("lat", lat1, lat2), ("lon", lon1, lon2)]
    sides += [(c, F.col(f"{c}1"), F.col(f"{c}2")) for c in carry]
    firsts = [F.when(swap, b).otherwise(a).alias(f"{name}1") for name, a, b in sides]
    seconds = [F.when(swap, a).otherwise(b).alias(f"{name}2") for name, a, b in sides]
    return firsts + seconds


def cell_label(lat: Column, lon: Column) -> Column:
    return F.format_string("(%s, %s)", lat.cast("string"), lon.cast("string"))


def pair_label(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.format_string("(%s, %s)", cell_label(lat1, lon1), cell_label(lat2, lon2))


def cell_block(blocks: Column) -> Column:
    """Which of ``blocks`` hash blocks a cell belongs to."""
    return F.pmod(F.xxhash64("lat", "lon"), blocks)
