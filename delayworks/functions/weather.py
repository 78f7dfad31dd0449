"""Expressions on packed station-observation groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Missing-value codes, accepted quality codes, slot times, code books.
MISSING = {"wind_dir": 999, "wind_speed": 9999, "ceiling": 99999, "visibility": 999999,
           "temp": 9999, "dew": 9999, "slp": 99999}
QC_STRICT = ("1", "5")
QC_AIR = ("1", "5", "I", "C")
SLOTS = ("00:00", "03:00", "06:00", "09:00", "12:00", "15:00", "18:00", "21:00")
STATIONS = {
    "JFK INTERNATIONAL AIRPORT, NY US": "JFK",
    "LAGUARDIA AIRPORT, NY US": "LGA",
    "NEWARK LIBERTY INTERNATIONAL AIRPORT, NJ US": "EWR",
}
WIND_TYPES = {"A": 0, "B": 1, "C": 2, "H": 3, "N": 4, "R": 5, "Q": 6, "T": 7, "V": 8}
CEILING_CODES = {"A": 0, "B": 1, "C": 2, "E": 3, "M": 4, "R": 5, "S": 6, "W": 7}
VISIBILITY_CODES = {"N": 0, "V": 1}
UNKNOWN_CODE = 9


def parts(group: str, least: int) -> Column:
    """Parts of a comma-packed group, null when there are fewer than ``least``."""
    array = F.split(F.col(group), ",")
    return F.when(F.size(array) >= least, array)


def number(array: Column, position: int, missing: int) -> Column:
    """Integer part, null when unreadable or equal to the missing code."""
    return F.nullif(F.get(array, F.lit(position)).try_cast("int"), F.lit(missing))


def text(array: Column, position: int) -> Column:
    return F.get(array, F.lit(position))


def tenths(value: Column) -> Column:
    return (value / F.lit(10.0)).cast("float")


def lookup(column, book: dict) -> Column:
    """Value of a code book; null for a code outside it."""
    column = F.col(column) if isinstance(column, str) else column
    entries = [F.lit(x) for pair in book.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), column)


def visibility_index(column="visibility_var_code") -> Column:
    """Known codes by the code book, missing as 9, any other code read as a number if it is one."""
    column = F.col(column)
    return F.coalesce(
        lookup(column, VISIBILITY_CODES),
        F.when(column.isNull(), F.lit(UNKNOWN_CODE)),
        column.try_cast("int"),
    )
