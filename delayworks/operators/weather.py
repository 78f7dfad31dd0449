"""Bronze and silver steps on station observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from delayworks.functions import weather as wx
from delayworks.operators.cleaning import keep_first
from delayworks.operators.features import move_first
from delayworks.sources.schemas import WEATHER_COLUMNS

GROUPS = ("WND", "CIG", "VIS", "TMP", "DEW", "SLP")
FILLED = (
    "wind_dir_deg", "wind_type", "wind_speed_mps", "ceiling_m", "ceiling_code", "visibility_m",
    "visibility_var_code", "temp_c", "dewpoint_c", "slp_hpa",
)


def with_times(df: DataFrame) -> DataFrame:
    """Observation time stamp, day and 'HH:mm' from the ISO text, whatever the session's time zone."""
    stamp = F.col("DATE").try_cast("timestamp_ntz")
    return df.select(*[c for c in WEATHER_COLUMNS if c != "DATE"], stamp.alias("timestamp")).select(
        "*",
        F.col("timestamp").cast("date").alias("date"),
        F.substring(F.col("timestamp").cast("string"), 12, 5).alias("time"),
    )


def latest_observation(df: DataFrame) -> DataFrame:
    """Latest record per station, day and minute; ties go to the smallest raw groups."""
    order = [F.col("timestamp").desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in GROUPS]]
    return keep_first(df, ["NAME", "date", "time"], order).drop("timestamp")


def parse_wind(df: DataFrame) -> DataFrame:
    p = wx.parts("WND", 5)
    return df.withColumns({
        "wind_dir_deg": wx.number(p, 0, wx.MISSING["wind_dir"]).cast("float"),
        "wind_type": wx.text(p, 2),
        "wind_speed_mps": wx.tenths(wx.number(p, 3, wx.MISSING["wind_speed"])),
        "wind_dir_qc": wx.text(p, 1),
        "wind_speed_qc": wx.text(p, 4),
    })


def parse_ceiling(df: DataFrame) -> DataFrame:
    p = wx.parts("CIG", 4)
    return df.withColumns({
        "ceiling_m": wx.number(p, 0, wx.MISSING["ceiling"]).cast("float"),
        "ceiling_code": wx.text(p, 2),
        "ceiling_qc": wx.text(p, 1),
    })


def parse_visibility(df: DataFrame) -> DataFrame:
    p = wx.parts("VIS", 4)
    return df.withColumns({
        "visibility_m": wx.number(p, 0, wx.MISSING["visibility"]).cast("float"),
        "visibility_var_code": wx.text(p, 2),
        "visibility_qc": wx.text(p, 1),
    })


def parse_temp_dew_slp(df: DataFrame) -> DataFrame:
    tmp, dew, slp = (wx.parts(g, 2) for g in ("TMP", "DEW", "SLP"))
    return df.withColumns({
        "temp_c": wx.tenths(wx.number(tmp, 0, wx.MISSING["temp"])),
        "temp_qc": wx.text(tmp, 1),
        "dewpoint_c": wx.tenths(wx.number(dew, 0, wx.MISSING["dew"])),
        "dewpoint_qc": wx.text(dew, 1),
        "slp_hpa": wx.tenths(wx.number(slp, 0, wx.MISSING["slp"])),
        "slp_qc": wx.text(slp, 1),
    })


def parse_groups(df: DataFrame) -> DataFrame:
    parsed = df.transform(parse_wind).transform(parse_ceiling) \
        .transform(parse_visibility).transform(parse_temp_dew_slp)
    return parsed.drop(*GROUPS)


def quality_filter(df: DataFrame) -> DataFrame:
    """Observations whose seven quality codes are all accepted; the codes are dropped."""
    strict = ("wind_dir_qc", "wind_speed_qc", "ceiling_qc", "visibility_qc", "slp_qc")
    air = ("temp_qc", "dewpoint_qc")
    ok = F.lit(True)
    for c in strict:
        ok = ok & F.col(c).isin(*wx.QC_STRICT)
    for c in air:
        ok = ok & F.col(c).isin(*wx.QC_AIR)
    return df.where(ok).drop(*strict, *air)


def to_grid(df: DataFrame) -> DataFrame:
    """Eight slots for every station and day seen; values where an observation falls on the slot.

    One aggregation per station and day keeps the slot observations and gives the empty
    slots, so the observations are computed once and not joined to themselves.
    """
    values = [c for c in df.columns if c not in ("NAME", "date", "time")]
    picked = [F.max(F.when(F.col("time") == slot, F.struct(*values))).alias(f"_{i}")
              for i, slot in enumerate(wx.SLOTS)]
    slots = F.array(*[F.struct(F.lit(slot).alias("time"), F.col(f"_{i}").alias("v"))
                      for i, slot in enumerate(wx.SLOTS)])
    days = df.groupBy("NAME", "date").agg(*picked)
    return days.select("NAME", "date", F.explode(slots).alias("s")).select(
        "NAME", "date", "s.time", *[F.col(f"s.v.{c}").alias(c) for c in values])


def fill_gaps(grid: DataFrame, columns=FILLED) -> DataFrame:
    """Last known value per station in time order, else the next known one.

    A station has eight grid rows per day whatever the number of raw records, so a
    window over its history is bounded by the calendar.
    """
    station = Window.partitionBy("NAME")
    onward = station.orderBy("date", "time").rowsBetween(Window.unboundedPreceding, 0)
    backward = station.orderBy(F.desc("date"), F.desc("time")).rowsBetween(Window.unboundedPreceding, 0)
    # Both frames grow row by row, so each pass is linear in the history.
    known = lambda window: {c: F.last(c, ignorenulls=True).over(window) for c in columns}
    return grid.withColumns(known(onward)).withColumns(known(backward))


def station_codes(df: DataFrame) -> DataFrame:
    return df.withColumn("NAME", wx.lookup("NAME", wx.STATIONS))


def encode(df: DataFrame) -> DataFrame:
    """Ordinal codes; an unknown or missing wind or ceiling code becomes 9."""
    coded = lambda c, book: F.coalesce(wx.lookup(c, book), F.lit(wx.UNKNOWN_CODE)).cast("int")
    return df.withColumns({
        "wind_type": coded("wind_type", wx.WIND_TYPES),
        "ceiling_code": coded("ceiling_code", wx.CEILING_CODES),
        "visibility_var_code_idx": wx.visibility_index().cast("int"),
    })


def forecast_shift(df: DataFrame, lag_days: int = 1) -> DataFrame:
    """Stand the observation of a day in for the forecast made ``lag_days`` earlier."""
    return df.select(
        F.col("NAME").alias("name"),
        F.date_sub("date", lag_days).alias("date"),
        F.translate("time", ":", "").alias("time"),
        F.col("date").alias("T+1_forecast"),
        *[c for c in df.columns if c not in ("NAME", "date", "time")],
    )


def bronze_weather(raw: DataFrame, end=None) -> DataFrame:
    """Raw observations with their day, up to a last day."""
    df = raw.withColumn("extracted_date", F.col("DATE").try_cast("timestamp_ntz").cast("date"))
    return df.where(F.col("extracted_date") <= F.lit(end).cast("date")) if end else df


def silver_weather(bronze: DataFrame, lag_days: int = 1) -> DataFrame:
    grid = (
        bronze.transform(with_times).transform(latest_observation)
        .transform(parse_groups).transform(quality_filter).transform(to_grid)
    )
    return (
        grid.transform(fill_gaps).transform(station_codes).transform(encode)
        .transform(forecast_shift, lag_days)
        .transform(move_first, "name", "date", "time", "T+1_forecast")
    )
