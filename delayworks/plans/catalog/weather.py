"""Weather layers and their single steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from delayworks.operators import weather as wx
from delayworks.plans import fixtures as fx
from delayworks.plans.oracle import WEATHER_FEATURES, WEATHER_VALUES, sql
from delayworks.plans.registry import query
from delayworks.sources import sinks

WHEN = 'NAME, d AS "date", t AS "time"'
KEYS = ("NAME", "date", "time")


def timed(spark, d):
    return fx.weather(spark, d).transform(wx.with_times)


def latest(spark, d):
    return timed(spark, d).transform(wx.latest_observation)


def accepted(spark, d):
    return latest(spark, d).transform(wx.parse_groups).transform(wx.quality_filter)


def grid(spark, d):
    return accepted(spark, d).transform(wx.to_grid)


def silver(spark, d):
    return wx.silver_weather(fx.weather(spark, d))


@query("weather_times", sql(f"SELECT {WHEN}, WND, TMP FROM timed", "timed"))
def weather_times(spark, d):
    return timed(spark, d).select(*KEYS, "WND", "TMP")


@query("weather_dedupe", sql(f"SELECT {WHEN}, WND, CIG, VIS, TMP, DEW, SLP FROM latest", "latest"))
def weather_dedupe(spark, d):
    return latest(spark, d)


@query("parse_wind", sql(f"SELECT {WHEN}, wind_dir_deg, wind_type, wind_speed_mps, wind_dir_qc, wind_speed_qc FROM parsed", "parsed"))
def parse_wind(spark, d):
    return latest(spark, d).transform(wx.parse_wind).select(
        *KEYS, "wind_dir_deg", "wind_type", "wind_speed_mps", "wind_dir_qc", "wind_speed_qc")


@query("parse_ceiling", sql(f"SELECT {WHEN}, ceiling_m, ceiling_code, ceiling_qc FROM parsed", "parsed"))
def parse_ceiling(spark, d):
    return latest(spark, d).transform(wx.parse_ceiling).select(*KEYS, "ceiling_m", "ceiling_code", "ceiling_qc")


@query("parse_visibility", sql(f"SELECT {WHEN}, visibility_m, visibility_var_code, visibility_qc FROM parsed", "parsed"))
def parse_visibility(spark, d):
    return latest(spark, d).transform(wx.parse_visibility).select(*KEYS, "visibility_m", "visibility_var_code", "visibility_qc")


@query("parse_temp_dew_slp", sql(f"SELECT {WHEN}, temp_c, temp_qc, dewpoint_c, dewpoint_qc, slp_hpa, slp_qc FROM parsed", "parsed"))
def parse_temp_dew_slp(spark, d):
    return latest(spark, d).transform(wx.parse_temp_dew_slp).select(
        *KEYS, "temp_c", "temp_qc", "dewpoint_c", "dewpoint_qc", "slp_hpa", "slp_qc")


VALUES = ", ".join(WEATHER_VALUES)


@query("weather_quality_filter", sql(f"SELECT {WHEN}, {VALUES} FROM accepted", "accepted"))
def weather_quality_filter(spark, d):
    return accepted(spark, d)


@query("weather_grid", sql(f"SELECT {WHEN}, {VALUES} FROM grid", "grid"))
def weather_grid(spark, d):
    return grid(spark, d)


@query("weather_fill", sql(f"SELECT {WHEN}, {VALUES} FROM filled", "filled"))
def weather_fill(spark, d):
    return grid(spark, d).transform(wx.fill_gaps)


@query("station_codes", sql("SELECT NAME AS code, count(*) AS n_rows FROM encoded GROUP BY NAME", "encoded"))
def station_codes(spark, d):
    rows = grid(spark, d).transform(wx.station_codes)
    return rows.groupBy(F.col("NAME").alias("code")).agg(F.count("*").alias("n_rows"))


@query("weather_encode", sql(f"SELECT {WHEN}, wind_type, ceiling_code, visibility_var_code_idx FROM encoded", "encoded"))
def weather_encode(spark, d):
    rows = grid(spark, d).transform(wx.fill_gaps).transform(wx.station_codes).transform(wx.encode)
    return rows.select(*KEYS, "wind_type", "ceiling_code", "visibility_var_code_idx")


@query("weather_forecast_shift", sql("""SELECT name, "date", "time", "T+1_forecast" FROM silver_weather""", "silver_weather"))
def weather_forecast_shift(spark, d):
    rows = grid(spark, d).transform(wx.station_codes).transform(wx.forecast_shift)
    return rows.select("name", "date", "time", "T+1_forecast")


@query("bronze_weather", sql("""
    SELECT r.*, CAST(CAST("DATE" AS TIMESTAMP) AS DATE) AS extracted_date,
           CASE WHEN CAST("DATE" AS TIMESTAMP) < TIMESTAMP '2001-06-01' THEN 'history' ELSE substr("DATE", 1, 10) END AS slice
    FROM raw_weather r WHERE CAST(CAST("DATE" AS TIMESTAMP) AS DATE) <= DATE '2001-07-15'""", "raw_weather"))
def bronze_weather(spark, d):
    return sinks.with_slice(wx.bronze_weather(fx.weather(spark, d), "2001-07-15"), "extracted_date", "2001-06-01")


@query("silver_weather", sql(f"""
    SELECT name, "date", "time", "T+1_forecast", {', '.join(WEATHER_FEATURES)} FROM silver_weather""", "silver_weather"))
def silver_weather(spark, d):
    return silver(spark, d)


@query("distinct_dates", sql("""
    SELECT DISTINCT CAST(d - 1 AS DATE) AS "date" FROM encoded WHERE d - 1 >= DATE '2000-01-01'""", "encoded"))
def distinct_dates(spark, d):
    from delayworks.operators.profile import distinct_dates as dates
    return dates(silver(spark, d).where("date >= date '2000-01-01'"), "date")
