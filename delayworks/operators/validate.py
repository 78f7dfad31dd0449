"""Checks of the stored layers: one pass each, as (check_name, value, status) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayworks.functions.flights import METRO, touches_metro
from delayworks.operators.cleaning import MAX_DISTANCE, MAX_ELAPSED
from delayworks.operators.features import SILVER_ONLY

# Derived columns of each layer and expected silver types.
BRONZE_DERIVED = (
    "year_month", "sort_time", "is_delayed_15", "DayOfWeek", "IsWeekend", "IsPublicHoliday",
    "source_file", "processing_timestamp", "FlightDate",
)
SILVER_TYPES = {"FlightDate": "date", "is_delayed_15": "int", "OP_UNIQUE_CARRIER": "string", "ARR_DELAY_NEW": "double"}
GOLD_REQUIRED = (
    "IS_DELAYED", "dep_3hour_col", "arr_3hour_col", "flight_id", "daily_flights", "volume_zscore",
    "is_rare", "is_abnormal_num", "is_peak_day", "is_extra_candidate",
)
COMBINED_REQUIRED = ("IS_DELAYED", "dep_3hour_col", "arr_3hour_col", "flight_id", "is_extra_candidate")


#: Least share of combined rows that have weather.
LEAST_COVERAGE = 0.8


class ValidationError(ValueError):
    """A check failed in strict mode."""


def _report(df: DataFrame, values: dict[str, Column], tests: dict[str, Column], strict: bool) -> DataFrame:
    """``values`` are aggregates; ``tests`` are conditions on them; a value without a test is information."""
    sums = df.agg(*[v.alias(k) for k, v in values.items()])
    rows = F.array(*[F.struct(
        F.lit(k).alias("check_name"), F.col(k).cast("string").alias("value"),
        (F.when(tests[k], "pass").otherwise("fail") if k in tests else F.lit("info")).alias("status"),
    ) for k in values])
    report = sums.select(F.inline(rows))
    if strict:
        failed = [r["check_name"] for r in report.where("status = 'fail'").collect()]  # one row per check
        if failed:
            raise ValidationError(f"failed checks: {failed}")
    return report


def _present(df: DataFrame, columns) -> Column:
    return F.max(F.lit(sum(c in df.columns for c in columns)))


def validate_bronze(df: DataFrame, min_rows: int, max_rows: int, first_day, last_day,
                    metro=METRO, strict: bool = False) -> DataFrame:
    """Row count, date bounds, metro coverage, target split, derived columns."""
    c = F.col
    values = {
        "total_rows": F.count("*"), "min_date": F.min("FlightDate"), "max_date": F.max("FlightDate"),
        "metro_rows": F.count_if(touches_metro(metro)),
        "delayed_rows": F.count_if(c("is_delayed_15") == 1), "on_time_rows": F.count_if(c("is_delayed_15") == 0),
        "derived_columns": _present(df, BRONZE_DERIVED),
    }
    tests = {
        "total_rows": c("total_rows").between(min_rows, max_rows),
        "min_date": c("min_date") >= F.lit(first_day).cast("date"),
        "max_date": c("max_date") <= F.lit(last_day).cast("date"),
        "metro_rows": c("metro_rows") == c("total_rows"),
        "derived_columns": c("derived_columns") == len(BRONZE_DERIVED),
    }
    return _report(df, values, tests, strict)


def _few_distinct(column: str) -> Column:
    """Distinct values of a column that has a handful (a wide distinct count would expand every row)."""
    return F.size(F.collect_set(column)).cast("bigint")


def validate_silver(df: DataFrame, strict: bool = False) -> DataFrame:
    """Nothing cancelled or diverted, target split, key types, outliers."""
    c = F.col
    kinds = dict(df.dtypes)
    values = {
        "total_rows": F.count("*"),
        "cancelled_rows": F.count_if(c("CANCELLED") == 1), "diverted_rows": F.count_if(c("DIVERTED") == 1),
        "delayed_rows": F.count_if(c("is_delayed_15") == 1), "on_time_rows": F.count_if(c("is_delayed_15") == 0),
        "typed_columns": F.max(F.lit(sum(kinds.get(k) == t for k, t in SILVER_TYPES.items()))),
        "long_flights": F.count_if(c("ACTUAL_ELAPSED_TIME") > MAX_ELAPSED),
        "far_flights": F.count_if(c("DISTANCE") > MAX_DISTANCE),
    }
    tests = {k: c(k) == 0 for k in ("cancelled_rows", "diverted_rows", "long_flights", "far_flights")}
    tests["typed_columns"] = c("typed_columns") == len(SILVER_TYPES)
    return _report(df, values, tests, strict)


def validate_gold(df: DataFrame, strict: bool = False) -> DataFrame:
    """Required columns, dropped columns, class split, buckets, flags, nulls in key columns."""
    c = F.col
    keys = ("IS_DELAYED", "dep_3hour_col", "arr_3hour_col", "flight_id")
    flags = ("is_rare", "is_abnormal_num", "is_peak_day", "is_extra_candidate")
    values = {
        "total_rows": F.count("*"), "required_columns": _present(df, GOLD_REQUIRED),
        "dropped_columns_found": _present(df, SILVER_ONLY),
        **{f"class_{k}_rows": F.count_if(c("IS_DELAYED") == k) for k in (0, 1, 2)},
        "dep_buckets": _few_distinct("dep_3hour_col"), "arr_buckets": _few_distinct("arr_3hour_col"),
        **{f"{f}_rows": F.count_if(c(f) == 1) for f in flags},
        **{f"{k}_nulls": F.count_if(c(k).isNull()) for k in keys},
    }
    tests = {
        "required_columns": c("required_columns") == len(GOLD_REQUIRED),
        "dropped_columns_found": c("dropped_columns_found") == 0,
        "class_0_rows": c("class_0_rows") + c("class_1_rows") + c("class_2_rows") == c("total_rows"),
        "IS_DELAYED_nulls": c("IS_DELAYED_nulls") == 0, "flight_id_nulls": c("flight_id_nulls") == 0,
    }
    return _report(df, values, tests, strict)


def validate_combined(df: DataFrame, flight_rows: Column | int, daily: bool = False,
                      min_coverage: float = LEAST_COVERAGE, strict: bool = False) -> DataFrame:
    """Column groups, class split, weather coverage, row count against the flights, date handling."""
    c = F.col
    weather = [x for x in df.columns if x.startswith("weather_")]
    flights = [x for x in df.columns if x not in weather and x != "snapshot_date"]
    expected = F.lit(flight_rows) if isinstance(flight_rows, int) else flight_rows
    values = {
        "total_rows": F.count("*"), "flight_rows": F.max(expected),
        "weather_columns": F.max(F.lit(len(weather))), "flight_columns": F.max(F.lit(len(flights))),
        **{f"class_{k}_rows": F.count_if(c("IS_DELAYED") == k) for k in (0, 1, 2)},
        "weather_rows": F.count_if(c(weather[0]).isNotNull()),
        "flight_date_columns": _present(df, ["FlightDate"]),
        "required_columns": _present(df, COMBINED_REQUIRED),
    }
    tests = {
        "flight_rows": c("flight_rows") == c("total_rows"),
        "weather_columns": c("weather_columns") > 0,
        "weather_rows": c("weather_rows") >= min_coverage * c("total_rows"),
        "flight_date_columns": c("flight_date_columns") == (0 if daily else 1),
        "required_columns": c("required_columns") == len(COMBINED_REQUIRED),
    }
    return _report(df, values, tests, strict)
