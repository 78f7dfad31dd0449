"""Lookup joins, weather legs, feature/label joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.functions.flights import METRO, bucket_slot
from delayworks.sources.staging import stage

# Weather columns that become features, and the ones dropped after the join.
WEATHER_FEATURES = (
    "wind_dir_deg", "wind_type", "wind_speed_mps", "ceiling_m", "ceiling_code", "visibility_m",
    "temp_c", "dewpoint_c", "slp_hpa", "visibility_var_code", "visibility_var_code_idx",
)
WEATHER_KEYS = ("weather_airport", "weather_date", "weather_time")
#: Most rows of a stored lookup that every executor holds; a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000


def lookup_join(df: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", null_safe: bool = False) -> DataFrame:
    """Join rows to a table with few rows per key.

    The planner chooses by the lookup's size in bytes whether to broadcast it; a shuffled join with a hot key is split
    at run time by its measured partition sizes. ``null_safe`` lets a null key match a null key.
    """
    if not null_safe:
        return df.join(lookup, on, how)
    right = lookup.withColumnsRenamed({c: f"_key_{c}" for c in on})
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`_key_{c}`")) for c in on]
    return df.join(right, same, how).drop(*[f"_key_{c}" for c in on])


def stored_lookup(lookup: DataFrame, name: str) -> DataFrame:
    """A derived lookup, written once. One of few rows is sent to the rows that look it up.

    The size of a lookup that is computed in the plan of the join is known only after both sides were shuffled.
    """
    stored = stage(lookup, name)
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def weather_lookup(weather: DataFrame) -> DataFrame:
    """Weather with its join keys renamed and its features prefixed."""
    names = {c: f"weather_{c}" for c in WEATHER_FEATURES}
    names |= {"name": "weather_airport", "date": "weather_date", "time": "weather_time"}
    return weather.drop("T+1_forecast").withColumnsRenamed(names)


def with_slots(flights: DataFrame) -> DataFrame:
    return flights.withColumns({
        "dep_weather_time": bucket_slot("dep_3hour_col"),
        "arr_weather_time": bucket_slot("arr_3hour_col"),
    })


def explode_legs(flights: DataFrame, metro=METRO, legs=("dep", "arr")) -> DataFrame:
    """One row per metro end of a flight, with the airport and slot whose weather applies.

    A flight between two metro airports gives two rows, one per leg. Both legs come
    from a single pass over the flights.
    """
    ends = {"dep": ("ORIGIN", "dep_3hour_col"), "arr": ("DEST", "arr_3hour_col")}
    options = F.array(*[
        F.when(F.col(airport).isin(*metro), F.struct(
            F.lit(leg).alias("leg"), F.col(airport).alias("weather_airport"),
            bucket_slot(bucket).alias("weather_time")))
        for leg, (airport, bucket) in ends.items() if leg in legs
    ])
    return flights.select("*", F.explode(F.filter(options, lambda x: x.isNotNull())).alias("_leg")) \
        .select(*flights.columns, "_leg.leg", "_leg.weather_airport", "_leg.weather_time")


def join_weather(flights: DataFrame, weather: DataFrame, daily: bool = False, legs=("dep", "arr"),
                 keep_leg: bool = False, stored: bool = True) -> DataFrame:
    """Weather at the metro end of each flight; flights without an observation keep nulls.

    ``daily`` leaves the date out of the key: both sides then hold one day only. ``stored`` writes the weather of more
    days first, eight rows a station and day whatever the number of flights; else it is computed in the plan of the join.
    """
    rows = explode_legs(flights, legs=legs)
    lookup = weather_lookup(weather)
    on = ["weather_airport", "weather_time"]
    if daily:
        lookup = lookup.drop("weather_date")
    else:
        rows, on = rows.withColumn("weather_date", F.col("FlightDate")), ["weather_date", *on]
    lookup = lookup.where(F.col("weather_airport").isNotNull())
    joined = lookup_join(rows, stored_lookup(lookup, "weather") if stored and not daily else lookup, on)
    return joined.drop(*WEATHER_KEYS, *([] if keep_leg else ["leg"]))


def union_legs(flights: DataFrame, metro=METRO) -> DataFrame:
    """Departing and arriving metro flights one below the other."""
    departing = flights.where(F.col("ORIGIN").isin(*metro)).withColumn("leg", F.lit("dep"))
    arriving = flights.where(F.col("DEST").isin(*metro)).withColumn("leg", F.lit("arr"))
    return departing.unionByName(arriving)


def features_with_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features that have a label: same customer, label day equal to the snapshot day."""
    right = labels.withColumnsRenamed({"snapshot_date": "label_snapshot_date"})
    return lookup_join(features, right, ["Customer_ID", "label_snapshot_date"], "inner")


def labels_with_features(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Every label, with the features of the same customer and day where there are any."""
    right = features.withColumnsRenamed({"label_snapshot_date": "snapshot_date"})
    return labels.join(right, ["Customer_ID", "snapshot_date"], "left")


def predictions_with_labels(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Predictions whose outcome is known."""
    keys = ["Customer_ID", "snapshot_date"]
    return lookup_join(predictions, labels.select(*keys, "label"), keys, "inner")
