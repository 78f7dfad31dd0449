"""Flight layers: bronze, silver, gold, and their single steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from delayworks.functions import flights as fn
from delayworks.functions.holidays import is_public_holiday
from delayworks.operators import cleaning, features, profile
from delayworks.plans import fixtures as fx
from delayworks.plans import jobs
from delayworks.plans import oracle
from delayworks.plans.catalog.io import dated
from delayworks.plans.oracle import METRO, sql
from delayworks.plans.registry import query
from delayworks.sources.staging import stage

ID = ("OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST", "FlightDate", "CRS_DEP_TIME")
ID_SQL = ", ".join(ID)


def bronze(spark, d, day=None):
    return jobs.bronze_flights(fx.with_source_file(fx.flights(spark, d)), day)


def silver(spark, d):
    return jobs.silver_flights(bronze(spark, d))


def stored_silver(spark, d):
    """Silver as the table the gold job reads."""
    return stage(silver(spark, d), "silver")


def gold(spark, d):
    return jobs.gold_flights(stored_silver(spark, d)).drop("processing_timestamp")


def rounded_score(df):
    return df.withColumn("volume_zscore", F.round("volume_zscore", 6))


# --- bronze -------------------------------------------------------------------

def _simple(name: str, column, expression: str):
    """A one-column step over the raw flights, next to the columns that identify a flight."""
    @query(name, sql(f"SELECT {ID_SQL}, {expression} AS {name} FROM dated", "dated"))
    def run(spark, d):
        return dated(spark, d).select(*ID, column().alias(name))


@query("date_from_parts", sql("""
    SELECT YEAR, MONTH, DAY_OF_MONTH, ORIGIN, FlightDate,
           TRY_CAST(YEAR || '-' || MONTH || '-' || (DAY_OF_MONTH + 3) AS DATE) AS shifted_date FROM dated""", "dated"))
def date_from_parts(spark, d):
    shifted = fn.date_from_parts(day=F.col("DAY_OF_MONTH") + 3)  # some of these are no dates
    return dated(spark, d).select("YEAR", "MONTH", "DAY_OF_MONTH", "ORIGIN", "FlightDate", shifted.alias("shifted_date"))


@query("metro_filter", sql(f"SELECT {ID_SQL} FROM dated WHERE ORIGIN IN {METRO} OR DEST IN {METRO}", "dated"))
def metro_filter(spark, d):
    return fx.flights(spark, d).transform(cleaning.load_filter).select(*ID)


_simple("year_month", fn.year_month, "strftime(FlightDate, '%Y-%m')")
_simple("sort_time", fn.sort_time, f"CASE WHEN ORIGIN IN {METRO} THEN CRS_DEP_TIME ELSE CRS_ARR_TIME END")
_simple("is_delayed_15", fn.is_delayed_15, "CASE WHEN ARR_DELAY_NEW >= 15 THEN 1 ELSE 0 END")
_simple("day_of_week", fn.day_of_week, "CAST(dayofweek(FlightDate) + 1 AS INT)")
_simple("is_weekend", fn.is_weekend, "CASE WHEN dayofweek(FlightDate) IN (0, 6) THEN 1 ELSE 0 END")
_simple("month_floor", lambda: fn.month_floor("FlightDate"), "CAST(date_trunc('month', FlightDate) AS DATE)")
_simple("delay_class", fn.delay_class,
        """CASE WHEN greatest(coalesce(DEP_DELAY_NEW, 0), coalesce(ARR_DELAY_NEW, 0)) < 60 THEN 0
                WHEN greatest(coalesce(DEP_DELAY_NEW, 0), coalesce(ARR_DELAY_NEW, 0)) < 120 THEN 1 ELSE 2 END""")
_simple("flight_id", fn.flight_id, "OP_UNIQUE_CARRIER || '_' || OP_CARRIER_FL_NUM")
_simple("is_abnormal_num", fn.is_abnormal_num, "CASE WHEN OP_CARRIER_FL_NUM > 8000 THEN 1 ELSE 0 END")


@query("is_public_holiday", sql(f"""
    SELECT {ID_SQL}, CASE WHEN FlightDate IN (SELECT holiday_date FROM holidays) THEN 1 ELSE 0 END AS is_public_holiday
    FROM dated""", "dated", "holidays"))
def public_holiday(spark, d):
    return dated(spark, d).select(*ID, is_public_holiday().alias("is_public_holiday"))


@query("holiday_calendar", sql("""
    SELECT CAST(year(holiday_date) AS INT) AS year, CAST(holiday_date AS DATE) AS holiday_date, holiday_name FROM holidays
    WHERE year(holiday_date) BETWEEN (SELECT min(year(d)) FROM lines) AND (SELECT max(year(d)) FROM lines)""", "holidays"))
def holiday_calendar(spark, d):
    return cleaning.holiday_calendar(dated(spark, d)).select("year", "holiday_date", "holiday_name")


@query("bronze_flights", sql("SELECT * FROM bronze", "bronze"))
def bronze_flights(spark, d):
    return bronze(spark, d).drop("processing_timestamp")


@query("bronze_flights_daily", sql("""
    SELECT *, DATE '1998-06-15' AS snapshot_date FROM bronze WHERE FlightDate = DATE '1998-06-15'""", "bronze"))
def bronze_flights_daily(spark, d):
    return bronze(spark, d, "1998-06-15").drop("processing_timestamp")


# --- silver -------------------------------------------------------------------

@query("normalise_strings", sql(f"""
    SELECT {ID_SQL}, trim(upper(TAIL_NUM)) AS TAIL_NUM, trim(upper(CANCELLATION_CODE)) AS CANCELLATION_CODE FROM dated""", "dated"))
def normalise_strings(spark, d):
    return dated(spark, d).transform(cleaning.normalise_strings).select(*ID, "TAIL_NUM", "CANCELLATION_CODE")


TEXT_COLUMNS = ("YEAR", "OP_CARRIER_FL_NUM", "DISTANCE", "ARR_DELAY_NEW", "ACTUAL_ELAPSED_TIME", "CANCELLED", "DIVERTED")


@query("enforce_types", sql("""
    SELECT OP_UNIQUE_CARRIER, trim(upper(TAIL_NUM)) AS TAIL_NUM, YEAR, OP_CARRIER_FL_NUM, ARR_DELAY_NEW, ACTUAL_ELAPSED_TIME,
           CASE WHEN DISTANCE < 6000 THEN DISTANCE END AS DISTANCE, CANCELLED, DIVERTED FROM flights""", "flights"))
def enforce_types(spark, d):
    """Types restored from text, in which far distances are not numbers."""
    raw = fx.flights(spark, d).select("OP_UNIQUE_CARRIER", "TAIL_NUM", *[F.col(c).cast("string").alias(c) for c in TEXT_COLUMNS])
    raw = raw.withColumn("DISTANCE", F.when(F.col("DISTANCE") == "6500", "far").otherwise(F.col("DISTANCE")))
    return raw.transform(cleaning.enforce_types)


@query("dedupe_flights", sql(f"""
    SELECT * FROM dated QUALIFY row_number() OVER (
        PARTITION BY {ID_SQL} ORDER BY {oracle.ties((*oracle.FLIGHT_COLUMNS, 'FlightDate'))}) = 1""", "dated"))
def dedupe_flights(spark, d):
    return dated(spark, d).transform(cleaning.dedupe_flights)


@query("duplicate_groups", sql(f"SELECT {ID_SQL}, count(*) AS copies FROM dated GROUP BY ALL HAVING count(*) > 1", "dated"))
def duplicate_groups(spark, d):
    return dated(spark, d).transform(cleaning.duplicate_groups)


@query("drop_cancelled", sql(f"SELECT {ID_SQL}, CANCELLED, DIVERTED FROM dated WHERE CANCELLED <> 1 AND DIVERTED <> 1", "dated"))
def drop_cancelled(spark, d):
    return dated(spark, d).transform(cleaning.drop_cancelled).select(*ID, "CANCELLED", "DIVERTED")


@query("drop_cancelled_with_delay", sql(f"""
    SELECT {ID_SQL}, CANCELLED, DIVERTED, ARR_DELAY_NEW FROM dated
    WHERE NOT ((CANCELLED = 1 OR DIVERTED = 1) AND ARR_DELAY_NEW IS NOT NULL)""", "dated"))
def drop_cancelled_with_delay(spark, d):
    return dated(spark, d).transform(cleaning.drop_cancelled_with_delay).select(*ID, "CANCELLED", "DIVERTED", "ARR_DELAY_NEW")


@query("drop_outliers", sql(f"""
    SELECT {ID_SQL}, ACTUAL_ELAPSED_TIME, DISTANCE FROM dated
    WHERE coalesce(ACTUAL_ELAPSED_TIME, 0) <= 1440 AND coalesce(ACTUAL_ELAPSED_TIME, 0) >= 0 AND coalesce(DISTANCE, 0) <= 6000""", "dated"))
def drop_outliers(spark, d):
    return dated(spark, d).transform(cleaning.drop_outliers).select(*ID, "ACTUAL_ELAPSED_TIME", "DISTANCE")


@query("cleaning_report", sql("""
    , n AS (SELECT (SELECT count(*) FROM bronze) AS n0, (SELECT count(*) FROM deduped) AS n1,
              (SELECT count(*) FROM deduped WHERE CANCELLED <> 1 AND DIVERTED <> 1) AS n2,
              (SELECT count(*) FROM deduped WHERE CANCELLED <> 1 AND DIVERTED <> 1
                 AND NOT ((CANCELLED = 1 OR DIVERTED = 1) AND ARR_DELAY_NEW IS NOT NULL)) AS n3,
              (SELECT count(*) FROM silver) AS n4)
    SELECT 1 AS step_no, 'duplicates' AS step, n0 AS rows_before, n0 - n1 AS rows_removed, n1 AS rows_after FROM n
    UNION ALL SELECT 2, 'cancelled_diverted', n1, n1 - n2, n2 FROM n
    UNION ALL SELECT 3, 'cancelled_with_delay', n2, n2 - n3, n3 FROM n
    UNION ALL SELECT 4, 'outliers', n3, n3 - n4, n4 FROM n""", "silver"))
def cleaning_report(spark, d):
    return cleaning.cleaning_report(bronze(spark, d))


@query("silver_flights", sql("SELECT * FROM silver", "silver"))
def silver_flights(spark, d):
    return silver(spark, d).drop("processing_timestamp")


# --- gold ---------------------------------------------------------------------

@query("three_hour_bucket", sql(f"""
    SELECT {ID_SQL}, {oracle.bucket('DEP_TIME_BLK')} AS dep_3hour_col, {oracle.bucket('ARR_TIME_BLK')} AS arr_3hour_col FROM dated""", "dated"))
def three_hour_bucket(spark, d):
    return dated(spark, d).transform(features.add_buckets).select(*ID, "dep_3hour_col", "arr_3hour_col")


@query("bucket_slot", sql(f"""
    SELECT {ID_SQL}, substr({oracle.bucket('DEP_TIME_BLK')}, 1, 4) AS dep_weather_time,
           substr({oracle.bucket('ARR_TIME_BLK')}, 1, 4) AS arr_weather_time FROM dated""", "dated"))
def bucket_slot(spark, d):
    from delayworks.operators.joins import with_slots
    return dated(spark, d).transform(features.add_buckets).transform(with_slots).select(*ID, "dep_weather_time", "arr_weather_time")


@query("daily_volume", sql("""
    SELECT OP_UNIQUE_CARRIER, ORIGIN, FlightDate, count(*) AS daily_flights FROM silver GROUP BY ALL""", "silver"))
def daily_volume(spark, d):
    return features.daily_volume(silver(spark, d))


@query("volume_stats", sql("""
    SELECT OP_UNIQUE_CARRIER, ORIGIN, count(*) AS flights, round(avg(daily_flights), 6) AS mean_flights,
           round(stddev_samp(daily_flights), 6) AS stddev_flights FROM volume GROUP BY ALL""", "volume"))
def volume_stats(spark, d):
    stats = features.route_stats(silver(spark, d))
    return stats.withColumns({c: F.round(c, 6) for c in ("mean_flights", "stddev_flights")})


@query("volume_stats_join", sql(f"""
    SELECT {ID_SQL}, daily_flights, round(mean_flights, 6) AS mean_flights, round(stddev_flights, 6) AS stddev_flights FROM volume""", "volume"))
def volume_stats_join(spark, d):
    from delayworks.operators.joins import lookup_join
    rows = stored_silver(spark, d)
    stats = features.volume_stats(features.daily_volume(rows))
    joined = lookup_join(rows.select(*ID), stats, features.VOLUME_KEY)
    return joined.withColumns({c: F.round(c, 6) for c in ("mean_flights", "stddev_flights")})


@query("volume_zscore", sql(f"SELECT {ID_SQL}, daily_flights, volume_zscore FROM scored_volume", "scored_volume"))
def volume_zscore(spark, d):
    return rounded_score(features.attach_volume(stored_silver(spark, d)).select(*ID, "daily_flights", "volume_zscore"))


@query("volume_zscore_history", sql("""
    , past AS (SELECT OP_UNIQUE_CARRIER, ORIGIN, avg(daily_flights) AS m, stddev_samp(daily_flights) AS sd
               FROM (SELECT *, count(*) OVER (PARTITION BY OP_UNIQUE_CARRIER, ORIGIN, FlightDate) AS daily_flights
                     FROM silver WHERE FlightDate < DATE '1998-06-15') GROUP BY ALL)
    SELECT s.OP_UNIQUE_CARRIER, s.ORIGIN, s.OP_CARRIER_FL_NUM, s.DEST, s.CRS_DEP_TIME, s.daily_flights,
           round(CASE WHEN sd > 0 THEN (s.daily_flights - m) / sd ELSE 0 END, 6) AS volume_zscore
    FROM volume s LEFT JOIN past USING (OP_UNIQUE_CARRIER, ORIGIN) WHERE FlightDate = DATE '1998-06-15'""", "volume"))
def volume_zscore_history(spark, d):
    """A one-day slice scored with the statistics of the days before it."""
    rows = stored_silver(spark, d)
    day, past = rows.where("FlightDate = date '1998-06-15'"), rows.where("FlightDate < date '1998-06-15'")
    return rounded_score(features.attach_volume(day, past).select(
        "OP_UNIQUE_CARRIER", "ORIGIN", "OP_CARRIER_FL_NUM", "DEST", "CRS_DEP_TIME", "daily_flights", "volume_zscore"))


@query("is_rare", sql(f"""
    SELECT {ID_SQL}, OP_UNIQUE_CARRIER || '_' || OP_CARRIER_FL_NUM AS flight_id,
           CASE WHEN flight_count < 3 THEN 1 ELSE 0 END AS is_rare FROM volume""", "volume"))
def is_rare(spark, d):
    return features.attach_rare(stored_silver(spark, d).select(*ID)).select(*ID, "flight_id", "is_rare")


@query("is_peak_day", sql(f"""
    SELECT {ID_SQL}, CASE WHEN volume_zscore > 2 THEN 1 ELSE 0 END AS is_peak_day FROM scored_volume""", "scored_volume"))
def is_peak_day(spark, d):
    return features.attach_volume(stored_silver(spark, d)).select(*ID, fn.is_peak_day().alias("is_peak_day"))


@query("is_extra_candidate", sql(f"SELECT {ID_SQL}, is_extra_candidate FROM gold", "gold"))
def is_extra_candidate(spark, d):
    return gold(spark, d).select(*ID, "is_extra_candidate")


@query("gold_flights", sql("SELECT * FROM gold", "gold"))
def gold_flights(spark, d):
    return rounded_score(gold(spark, d))


@query("gold_flights_daily", sql("""
    SELECT OP_UNIQUE_CARRIER, ORIGIN, DEST, flight_id, daily_flights, CAST(0 AS DOUBLE) AS volume_zscore,
           CASE WHEN count(*) OVER (PARTITION BY flight_id) < 3 THEN 1 ELSE 0 END AS is_rare, 0 AS is_peak_day, IS_DELAYED
    FROM gold WHERE FlightDate = DATE '1998-06-15'""", "gold"))
def gold_flights_daily(spark, d):
    """One day on its own: the volume of a route has no deviation, so its score is 0."""
    day = "1998-06-15"
    rows = stage(silver(spark, d).where(F.col("FlightDate") == F.lit(day).cast("date")), "day")
    return rounded_score(jobs.gold_flights(rows, day)).select(
        "OP_UNIQUE_CARRIER", "ORIGIN", "DEST", "flight_id", "daily_flights", "volume_zscore", "is_rare", "is_peak_day", "IS_DELAYED")


@query("distinct_buckets", sql("""
    SELECT 'dep_3hour_col' AS "column", count(DISTINCT coalesce(dep_3hour_col, '-')) AS n_distinct FROM gold
    UNION ALL SELECT 'arr_3hour_col', count(DISTINCT coalesce(arr_3hour_col, '-')) FROM gold""", "gold"))
def distinct_buckets(spark, d):
    return profile.distinct_counts(silver(spark, d).transform(features.add_buckets), profile.SLOT_COLUMNS)


@query("sample_buckets", sql(f"""
    SELECT DISTINCT DEP_TIME_BLK, {oracle.bucket('DEP_TIME_BLK')} AS dep_3hour_col FROM silver ORDER BY 1, 2 LIMIT 5""", "silver"))
def sample_buckets(spark, d):
    return profile.sample_values(silver(spark, d).transform(features.add_buckets), ["DEP_TIME_BLK", "dep_3hour_col"], 5)


@query("flag_rates", sql("\n".join(
    f"{'UNION ALL ' if i else ''}SELECT '{c}' AS \"column\", CAST(sum({c}) AS BIGINT) AS n_set, round(100.0 * sum({c}) / count(*), 6) AS pct FROM gold"
    for i, c in enumerate(profile.FLAG_COLUMNS)), "gold"))
def flag_rates(spark, d):
    return profile.flag_rates(gold(spark, d))


@query("class_distribution", sql("""
    SELECT IS_DELAYED, count(*) AS n_rows, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct
    FROM gold GROUP BY IS_DELAYED""", "gold"))
def class_distribution(spark, d):
    return profile.class_distribution(silver(spark, d).withColumn("IS_DELAYED", fn.delay_class()), "IS_DELAYED")
