"""Bronze and silver steps on flights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from delayworks.functions import flights as fx
from delayworks.functions.holidays import holiday_name, is_public_holiday
from delayworks.sources import schemas
from delayworks.sources.schemas import resolve, try_resolve

# Key of a flight, limits of plausible values.
FLIGHT_KEY = ("FlightDate", "OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST", "CRS_DEP_TIME")
MAX_ELAPSED, MAX_DISTANCE = 1440, 6000


def load_filter(df: DataFrame, day=None, metro=fx.METRO) -> DataFrame:
    """Add the flight date; keep one day (optional) and the flights that touch the metro area."""
    df = df.withColumn("FlightDate", fx.date_from_parts())
    if day is not None:
        df = df.where(F.col("FlightDate") == F.lit(day).cast("date"))
    return df.where(fx.touches_metro(metro))


def add_derived(df: DataFrame, metro=fx.METRO) -> DataFrame:
    """Partition key, sort time, target flag and calendar columns in one projection."""
    return df.withColumns({
        "year_month": fx.year_month(),
        "sort_time": fx.sort_time(metro),
        "is_delayed_15": fx.is_delayed_15(),
        "DayOfWeek": fx.day_of_week(),
        "IsWeekend": fx.is_weekend(),
        "IsPublicHoliday": is_public_holiday(),
        "processing_timestamp": F.current_timestamp(),
    })


def holiday_calendar(df: DataFrame, date_col: str = "FlightDate") -> DataFrame:
    """Holidays of every year that a table has dates in."""
    span = df.agg(F.trunc(F.min(date_col), "YEAR").alias("a"),
                  F.add_months(F.trunc(F.max(date_col), "YEAR"), 12).alias("b"))
    days = span.select(F.explode(F.sequence(F.col("a"), F.date_sub("b", 1))).alias("holiday_date"))
    named = days.withColumn("holiday_name", holiday_name("holiday_date"))
    return named.where(F.col("holiday_name").isNotNull()).withColumn("year", F.year("holiday_date"))


def normalise_strings(df: DataFrame, columns=schemas.FLIGHT_STRINGS) -> DataFrame:
    found = [c for c in (try_resolve(df, name) for name in columns) if c]
    return df.withColumns({c: F.trim(F.upper(F.col(c))) for c in found})


def enforce_types(df: DataFrame) -> DataFrame:
    """Silver types of the flight table; text that is no number becomes null."""
    types = dict.fromkeys(schemas.FLIGHT_INTS + schemas.FLIGHT_FLAGS, "int")
    types |= dict.fromkeys(schemas.FLIGHT_DOUBLES, "double")
    text = {c: F.trim(F.upper(F.col(c)))
            for c in (try_resolve(df, name) for name in schemas.FLIGHT_STRINGS) if c}
    return schemas.apply_types(df, types, **text)


def keep_first(df: DataFrame, key, order) -> DataFrame:
    """First row per key in a given order.

    The planner limits each key to one row inside every input split before the
    shuffle, so a key with very many copies does not travel as a whole. A hash of
    the key leads the sort: one number tells nearly all rows apart, where the first
    column of a key (a day) ties for most.
    """
    window = Window.partitionBy("_k", *key).orderBy(*order)
    rows = df.withColumn("_k", F.xxhash64(*key)).withColumn("_n", F.row_number().over(window))
    return rows.where("_n = 1").drop("_n", "_k")


def dedupe_flights(df: DataFrame) -> DataFrame:
    """One row per flight key; among copies the smallest in the remaining columns, taken by name."""
    key = [resolve(df, c) for c in FLIGHT_KEY]
    rest = sorted(c for c in df.columns if c not in key and c != "processing_timestamp")
    return keep_first(df, key, [F.col(c).asc_nulls_first() for c in rest])


def duplicate_groups(df: DataFrame) -> DataFrame:
    """Flight keys that occur more than once, with their number of rows."""
    key = [resolve(df, c) for c in FLIGHT_KEY]
    return df.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1")


def _cancelled_or_diverted(df: DataFrame):
    return F.col(resolve(df, "CANCELLED")), F.col(resolve(df, "DIVERTED"))


def drop_cancelled(df: DataFrame) -> DataFrame:
    """Flights that were neither cancelled nor diverted; a missing flag is dropped as well."""
    cancelled, diverted = _cancelled_or_diverted(df)
    return df.where((cancelled != 1) & (diverted != 1))


def _cancelled_with_delay(df: DataFrame):
    cancelled, diverted = _cancelled_or_diverted(df)
    return ((cancelled == 1) | (diverted == 1)) & F.col(resolve(df, "ARR_DELAY_NEW")).isNotNull()


def drop_cancelled_with_delay(df: DataFrame) -> DataFrame:
    """Drop cancelled or diverted flights that report a delay, and rows where that cannot be told."""
    return df.where(~_cancelled_with_delay(df)) if try_resolve(df, "ARR_DELAY_NEW") else df


def plausible() -> F.Column:
    elapsed, distance = F.col("ACTUAL_ELAPSED_TIME"), F.col("DISTANCE")
    return ((elapsed.isNull() | elapsed.between(0, MAX_ELAPSED))
            & (distance.isNull() | (distance <= MAX_DISTANCE)))


def drop_outliers(df: DataFrame) -> DataFrame:
    """Drop impossible elapsed times and distances; missing values stay."""
    return df.where(plausible())


def cleaning_report(df: DataFrame) -> DataFrame:
    """Rows before, removed and after each silver step, from one pass over the bronze rows.

    The rows are first reduced to one per flight key with the number of its copies; the steps are then counted together
    in a single aggregate.
    """
    key = [resolve(df, c) for c in FLIGHT_KEY]
    rest = sorted(c for c in df.columns if c not in key and c != "processing_timestamp")
    first = df.groupBy(*key).agg(F.count("*").alias("_copies"), F.min(F.struct(*rest)).alias("_r"))
    clean = enforce_types(first.select(*key, "_r.*", "_copies"))
    cancelled, diverted = _cancelled_or_diverted(clean)
    flown = F.coalesce((cancelled != 1) & (diverted != 1), F.lit(False))
    stated = F.coalesce(~_cancelled_with_delay(clean), F.lit(False))
    counts = clean.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("n0"),
        F.count("*").alias("n1"),
        F.count_if(flown).alias("n2"),
        F.count_if(flown & stated).alias("n3"),
        F.count_if(flown & stated & plausible()).alias("n4"),
    )
    steps = ("duplicates", "cancelled_diverted", "cancelled_with_delay", "outliers")
    rows = [F.struct(F.lit(i + 1).alias("step_no"), F.lit(step).alias("step"),
                     F.col(f"n{i}").alias("rows_before"),
                     (F.col(f"n{i}") - F.col(f"n{i + 1}")).alias("rows_removed"),
                     F.col(f"n{i + 1}").alias("rows_after")) for i, step in enumerate(steps)]
    return counts.select(F.inline(F.array(*rows)))


def load_report(df: DataFrame, day=None, metro=fx.METRO) -> DataFrame:
    """Rows read, rows on the wanted day and rows that touch the metro area, in one pass."""
    dated = df.withColumn("FlightDate", fx.date_from_parts())
    on_day = F.lit(True) if day is None else F.col("FlightDate") == F.lit(day).cast("date")
    return dated.agg(
        F.count("*").alias("rows_read"),
        F.count_if(on_day).alias("rows_on_day"),
        F.count_if(on_day & fx.touches_metro(metro)).alias("rows_kept"),
    )


def coerce_dates(df: DataFrame, date_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """Tolerant date parse; rows with a date and a label, and the rows set aside."""
    parsed = df.withColumn(date_col, fx.tolerant_date(date_col)) \
        .withColumn(label_col, F.col(label_col).try_cast("int"))
    usable = F.col(date_col).isNotNull() & F.col(label_col).isNotNull()
    return parsed.where(usable), parsed.where(~usable)
