"""Gold features of flights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from delayworks.functions import flights as fx
from delayworks.operators.joins import lookup_join, stored_lookup

# Columns that end at silver.
SILVER_ONLY = (
    "CANCELLED", "DIVERTED", "CANCELLATION_CODE", "source_file", "is_delayed_15",
    "processing_timestamp", "sort_time",
)
VOLUME_KEY = ["OP_UNIQUE_CARRIER", "ORIGIN", "FlightDate"]


def move_last(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in columns], *columns)


def move_first(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, *[c for c in df.columns if c not in columns])


def delay_target(df: DataFrame) -> DataFrame:
    return df.withColumn("IS_DELAYED", fx.delay_class()).transform(move_last, "IS_DELAYED")


def add_buckets(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "dep_3hour_col": fx.three_hour_bucket("DEP_TIME_BLK"),
        "arr_3hour_col": fx.three_hour_bucket("ARR_TIME_BLK"),
    })


def daily_volume(df: DataFrame) -> DataFrame:
    """Flights per carrier, origin and day."""
    return df.groupBy(*VOLUME_KEY).agg(F.count("*").alias("daily_flights"))


def volume_stats(daily: DataFrame) -> DataFrame:
    """Mean and sample deviation of the daily volume per carrier and origin, weighted by flights.

    Works on the daily counts, of which a carrier and origin have one per day, and
    weights each by itself; the flights are not read again.
    """
    per_route = Window.partitionBy("OP_UNIQUE_CARRIER", "ORIGIN")
    n = F.col("daily_flights").cast("double")
    total = F.sum(n).over(per_route)
    mean = F.sum(n * n).over(per_route) / total
    spread = F.sum(n * (n - F.col("mean_flights")) * (n - F.col("mean_flights"))).over(per_route)
    return (
        daily.withColumn("mean_flights", mean)
        .withColumn("stddev_flights", F.when(total > 1, F.sqrt(spread / (total - 1))))
    )


def volume_zscore(stats: DataFrame) -> DataFrame:
    score = (F.col("daily_flights") - F.col("mean_flights")) / F.col("stddev_flights")
    return stats.withColumn("volume_zscore", F.when(F.col("stddev_flights") > 0, score).otherwise(0.0))


def route_stats(df: DataFrame) -> DataFrame:
    """One row per carrier and origin: rows, mean and deviation of the daily volume."""
    return volume_stats(daily_volume(df)).groupBy("OP_UNIQUE_CARRIER", "ORIGIN").agg(
        F.sum("daily_flights").alias("flights"),
        F.first("mean_flights").alias("mean_flights"),
        F.first("stddev_flights").alias("stddev_flights"),
    )


def attach_volume(df: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Daily volume and its z-score on every flight.

    With ``history`` the mean and deviation come from that table instead of the rows
    at hand, which gives a one-day slice the statistics it was trained on.
    """
    if history is None:
        volume = volume_stats(daily_volume(df))
    else:
        volume = daily_volume(df).join(route_stats(history).drop("flights"), VOLUME_KEY[:2], "left")
    # A route without a carrier or an origin is counted, but has no statistics of its own.
    known = F.col("OP_UNIQUE_CARRIER").isNotNull() & F.col("ORIGIN").isNotNull()
    volume = volume_zscore(volume.withColumn("stddev_flights", F.when(known, F.col("stddev_flights"))))
    lookup = stored_lookup(volume.select(*VOLUME_KEY, "daily_flights", "volume_zscore"), "volume")
    return lookup_join(df, lookup, VOLUME_KEY, null_safe=True)


def flight_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(fx.flight_id().alias("flight_id")).agg(F.count("*").alias("flight_count"))


def attach_rare(df: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Flight identifier, and whether it occurs fewer than three times."""
    counts = stored_lookup(flight_counts(df if history is None else history), "flight_counts")
    rows = lookup_join(df.withColumn("flight_id", fx.flight_id()), counts, ["flight_id"])
    seldom = F.coalesce(F.col("flight_count"), F.lit(0)) < fx.RARE_BELOW
    return rows.withColumn("is_rare", fx.flag(seldom)).drop("flight_count")


def add_flags(df: DataFrame) -> DataFrame:
    df = df.withColumns({"is_abnormal_num": fx.is_abnormal_num(), "is_peak_day": fx.is_peak_day()})
    return df.withColumn("is_extra_candidate", fx.is_extra_candidate())


def flight_features(silver: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """All gold columns. ``silver`` should be a stored table: it is read three times."""
    base = silver.drop(*SILVER_ONLY).transform(delay_target).transform(add_buckets)
    return (
        base.transform(attach_volume, history)
        .transform(attach_rare, base if history is None else history)
        .transform(add_flags)
    )
