"""Typed column maps: which column is read as which type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Silver types of the flight table.
FLIGHT_STRINGS = ("OP_UNIQUE_CARRIER", "ORIGIN", "DEST", "TAIL_NUM", "CANCELLATION_CODE")
FLIGHT_INTS = (
    "YEAR", "MONTH", "DAY_OF_MONTH", "DAY_OF_WEEK", "OP_CARRIER_FL_NUM", "CRS_DEP_TIME",
    "CRS_ARR_TIME", "DISTANCE", "DISTANCE_GROUP", "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID",
)
FLIGHT_DOUBLES = (
    "DEP_TIME", "ARR_TIME", "ACTUAL_ELAPSED_TIME", "DEP_DELAY_NEW", "ARR_DELAY_NEW",
    "DEP_DELAY_GROUP", "ARR_DELAY_GROUP", "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY",
    "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
)
FLIGHT_FLAGS = ("CANCELLED", "DIVERTED", "is_delayed_15", "IsWeekend", "IsPublicHoliday")
# Types of the raw flight files: counts and flags may be written with decimals there.
RAW_FLIGHT_TYPES = (
    dict.fromkeys(FLIGHT_INTS, "int") | dict.fromkeys(FLIGHT_DOUBLES, "double")
    | dict.fromkeys(("DISTANCE", "DISTANCE_GROUP", "CANCELLED", "DIVERTED"), "double")
)
# Silver types of the loan snapshot.
LOAN_TYPES = {
    "loan_id": "string", "Customer_ID": "string", "loan_start_date": "date", "tenure": "int",
    "installment_num": "int", "loan_amt": "float", "due_amt": "float", "paid_amt": "float",
    "overdue_amt": "float", "balance": "float", "snapshot_date": "date",
}
# Columns of the station observations.
WEATHER_COLUMNS = ("DATE", "NAME", "WND", "CIG", "VIS", "TMP", "DEW", "SLP")
# Columns of the reference tables that are not text.
AIRPORT_TYPES = {"id": "bigint", "latitude_deg": "double", "longitude_deg": "double", "elevation_ft": "int"}
FREQUENCY_TYPES = {"id": "bigint", "airport_ref": "bigint", "frequency_mhz": "double"}


def try_resolve(df: DataFrame, name: str) -> str | None:
    """Actual spelling of a column looked up without regard to case, or None."""
    return {c.upper(): c for c in df.columns}.get(name.strip().upper())


def resolve(df: DataFrame, name: str) -> str:
    found = try_resolve(df, name)
    if found is None:
        raise KeyError(f"column {name!r} not found; have {df.columns}")
    return found


def apply_types(df: DataFrame, types: dict[str, str], **extra: Column) -> DataFrame:
    """Cast the listed columns that exist (unreadable values become null) in one projection."""
    wanted = {try_resolve(df, name): kind for name, kind in types.items()}
    columns = []
    for c in df.columns:
        if c in extra:
            columns.append(extra[c].alias(c))
        elif c in wanted:
            columns.append(F.col(f"`{c}`").try_cast(wanted[c]).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return df.select(*columns)
