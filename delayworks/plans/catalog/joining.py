"""Weather legs, feature and label joins, combined gold."""

from __future__ import annotations

from pyspark.sql import functions as F

from delayworks.operators import joins, runs, validate
from delayworks.plans import fixtures as fx
from delayworks.plans import jobs
from delayworks.plans.catalog import flights as fl
from delayworks.plans.catalog import weather as wx
from delayworks.plans.oracle import GOLD_COLUMNS, WEATHER_FEATURES, sql
from delayworks.plans.registry import query
from delayworks.sources import sinks
from delayworks.sources.staging import scratch_path

GOLD_SQL = ", ".join(f'"{c}"' for c in GOLD_COLUMNS)
WEATHER_SQL = ", ".join(f'"weather_{c}"' for c in WEATHER_FEATURES)
ID = fl.ID
SOME_WEATHER = ("weather_wind_type", "weather_temp_c", "weather_slp_hpa")
SOME_SQL = ", ".join(SOME_WEATHER)
DAY = "1998-06-15"


def combined(spark, d, merge=False, **options):
    weather = wx.silver(spark, d)
    return jobs.gold_combined(fl.gold(spark, d), weather.hint("merge") if merge else weather, stored=not merge, **options)


@query("join_departure_weather", sql(f"SELECT {fl.ID_SQL}, {SOME_SQL} FROM combined WHERE leg = 'dep'", "combined"))
def join_departure_weather(spark, d):
    return combined(spark, d, legs=("dep",)).select(*ID, *SOME_WEATHER)


@query("join_arrival_weather", sql(f"SELECT {fl.ID_SQL}, {SOME_SQL} FROM combined WHERE leg = 'arr'", "combined"))
def join_arrival_weather(spark, d):
    return combined(spark, d, legs=("arr",)).select(*ID, *SOME_WEATHER)


@query("join_weather_salted", sql(f"SELECT {fl.ID_SQL}, leg, {SOME_SQL} FROM combined", "combined"))
def join_weather_salted(spark, d):
    """The same join on the path taken when the weather is too large to broadcast."""
    return combined(spark, d, merge=True, keep_leg=True).select(*ID, "leg", *SOME_WEATHER)


@query("join_weather_daily", sql(f"""
    SELECT {fl.ID_SQL}, leg, {SOME_SQL} FROM combined WHERE FlightDate = DATE '{DAY}'""", "combined"))
def join_weather_daily(spark, d):
    day = F.lit(DAY).cast("date")
    rows = fl.gold(spark, d).where(F.col("FlightDate") == day)
    slots = wx.silver(spark, d).where(F.col("date") == day)
    return joins.join_weather(rows, slots, daily=True, keep_leg=True).select(*ID, "leg", *SOME_WEATHER)


@query("prefix_columns", sql(f"""
    SELECT name AS weather_airport, "date" AS weather_date, "time" AS weather_time,
           {', '.join(f'"{c}" AS "weather_{c}"' for c in WEATHER_FEATURES)} FROM silver_weather""", "silver_weather"))
def prefix_columns(spark, d):
    return joins.weather_lookup(wx.silver(spark, d))


@query("union_legs", sql(f"SELECT {fl.ID_SQL}, leg FROM legs", "legs"))
def union_legs(spark, d):
    return joins.union_legs(fl.silver(spark, d)).select(*ID, "leg")


@query("gold_combined", sql(f"SELECT {GOLD_SQL}, {WEATHER_SQL} FROM combined", "combined"))
def gold_combined(spark, d):
    return fl.rounded_score(combined(spark, d))


@query("gold_combined_daily", sql(f"""
    SELECT * EXCLUDE (FlightDate) FROM (SELECT {GOLD_SQL}, {WEATHER_SQL} FROM combined)
    WHERE snapshot_date = DATE '{DAY}'""", "combined"))
def gold_combined_daily(spark, d):
    """The daily job on stored tables: one slice of gold, made with the statistics of all of silver, and one of weather."""
    silver = fl.stored_silver(spark, d)
    gold, weather = scratch_path(spark, "gold"), scratch_path(spark, "weather")
    day = F.lit(DAY).cast("date")
    first, last = F.date_sub(day, 3), F.date_add(day, 3)
    week = jobs.gold_flights(silver.where(F.col("FlightDate").between(first, last)), history=silver).drop("processing_timestamp")
    sinks.write_partitioned(week, gold, "snapshot_date", jobs.BRONZE_ORDER[1:])
    sinks.write_cutoff_split(wx.silver(spark, d).where(F.col("date") <= last), weather, "date", DAY, ["time"])
    return fl.rounded_score(jobs.gold_combined(spark.read.parquet(gold), spark.read.parquet(weather), DAY).drop("slice"))


@query("features_labels_inner", sql("""
    SELECT f.*, l.label FROM fx_features f JOIN last_labels l
    ON f.Customer_ID = l.Customer_ID AND f.label_snapshot_date = l.snapshot_date""", "fx_features", "last_labels"))
def features_labels_inner(spark, d):
    labels = runs.latest_label(fx.labels(spark, d), "load_order").select("Customer_ID", "snapshot_date", "label")
    return joins.features_with_labels(fx.features(spark, d), labels)


@query("labels_features_left", sql("""
    SELECT l.Customer_ID, l.snapshot_date, l.label, f.feature_id, f.Occupation, f.Age_bin, f.fe_1, f.fe_2, f.fe_3
    FROM last_labels l LEFT JOIN fx_features f ON f.Customer_ID = l.Customer_ID AND f.label_snapshot_date = l.snapshot_date""",
    "fx_features", "last_labels"))
def labels_features_left(spark, d):
    labels = runs.latest_label(fx.labels(spark, d), "load_order").select("Customer_ID", "snapshot_date", "label")
    return joins.labels_with_features(labels, fx.features(spark, d))


@query("preds_labels_inner", sql("""
    SELECT s.Customer_ID, s.snapshot_date, s.default_proba, s.run_id, l.label FROM fx_scores s JOIN last_labels l
    ON s.Customer_ID = l.Customer_ID AND s.snapshot_date = l.snapshot_date""", "fx_scores", "last_labels"))
def preds_labels_inner(spark, d):
    labels = runs.latest_label(fx.labels(spark, d), "load_order")
    return joins.predictions_with_labels(runs.standard_scores(fx.scores(spark, d)), labels)


@query("latest_label", sql("SELECT * FROM last_labels", "last_labels"))
def latest_label(spark, d):
    return runs.latest_label(fx.labels(spark, d), "load_order")


def _checks(rows):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, CAST({value} AS VARCHAR) AS value, {status} AS status FROM t" for name, value, status in rows)


def _test(condition):
    return f"CASE WHEN {condition} THEN 'pass' ELSE 'fail' END"


INFO = "'info'"


@query("validate_bronze", sql(", t AS (SELECT count(*) AS n, min(FlightDate) AS a, max(FlightDate) AS b, sum(is_delayed_15) AS late FROM bronze) " + _checks([
    ("total_rows", "n", _test("n BETWEEN 1000 AND 100000000000")), ("min_date", "a", _test("a >= DATE '1995-01-01'")),
    ("max_date", "b", _test("b <= DATE '2000-12-31'")), ("metro_rows", "n", _test("true")),
    ("delayed_rows", "CAST(late AS BIGINT)", INFO), ("on_time_rows", "CAST(n - late AS BIGINT)", INFO), ("derived_columns", "9", _test("true"))]), "bronze"))
def validate_bronze(spark, d):
    return validate.validate_bronze(fl.bronze(spark, d), 1000, 100_000_000_000, "1995-01-01", "2000-12-31")


@query("validate_silver", sql(", t AS (SELECT count(*) AS n, CAST(sum(is_delayed_15) AS BIGINT) AS late FROM silver) " + _checks([
    ("total_rows", "n", INFO), ("cancelled_rows", "0", _test("true")), ("diverted_rows", "0", _test("true")),
    ("delayed_rows", "late", INFO), ("on_time_rows", "n - late", INFO), ("typed_columns", "4", _test("true")),
    ("long_flights", "0", _test("true")), ("far_flights", "0", _test("true"))]), "silver"))
def validate_silver(spark, d):
    return validate.validate_silver(fl.silver(spark, d))


_FLAGS = ("is_rare", "is_abnormal_num", "is_peak_day", "is_extra_candidate")


@query("validate_gold", sql(
    ", t AS (SELECT count(*) AS n, count(DISTINCT dep_3hour_col) AS db, count(DISTINCT arr_3hour_col) AS ab, "
    + ", ".join(f"count(*) FILTER (WHERE IS_DELAYED = {k}) AS c{k}" for k in (0, 1, 2)) + ", "
    + ", ".join(f"count(*) FILTER (WHERE {f} = 1) AS {f}_n" for f in _FLAGS)
    + ", count(*) FILTER (WHERE arr_3hour_col IS NULL) AS an FROM gold) " + _checks([
        ("total_rows", "n", INFO), ("required_columns", "10", _test("true")), ("dropped_columns_found", "0", _test("true")),
        ("class_0_rows", "c0", _test("c0 + c1 + c2 = n")), ("class_1_rows", "c1", INFO), ("class_2_rows", "c2", INFO),
        ("dep_buckets", "db", INFO), ("arr_buckets", "ab", INFO), *[(f"{f}_rows", f"{f}_n", INFO) for f in _FLAGS],
        ("IS_DELAYED_nulls", "0", _test("true")), ("dep_3hour_col_nulls", "0", INFO), ("arr_3hour_col_nulls", "an", INFO),
        ("flight_id_nulls", "0", _test("true"))]), "gold"))
def validate_gold(spark, d):
    return validate.validate_gold(fl.gold(spark, d))


@query("validate_combined", sql(
    ", t AS (SELECT count(*) AS n, (SELECT count(*) FROM gold) AS g, count(weather_wind_dir_deg) AS w, "
    + ", ".join(f"count(*) FILTER (WHERE IS_DELAYED = {k}) AS c{k}" for k in (0, 1, 2)) + " FROM combined) " + _checks([
        ("total_rows", "n", INFO), ("flight_rows", "g", _test("g = n")), ("weather_columns", "11", _test("true")),
        ("flight_columns", str(len(GOLD_COLUMNS) - 1), INFO), *[(f"class_{k}_rows", f"c{k}", INFO) for k in (0, 1, 2)],
        ("weather_rows", "w", _test("w >= 0.8 * n")), ("flight_date_columns", "1", _test("true")), ("required_columns", "5", _test("true"))]), "combined"))
def validate_combined(spark, d):
    gold = fl.gold(spark, d)  # silver and the lookups are stored; of gold only what is checked is computed
    joined = jobs.gold_combined(gold, wx.silver(spark, d))
    return validate.validate_combined(joined, gold.agg(F.count("*")).scalar())
