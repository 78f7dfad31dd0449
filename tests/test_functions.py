"""Column expressions on literal rows: nulls and edges."""

import datetime as dt

from pyspark.sql import functions as F

from delayworks.functions import flights as fn
from delayworks.functions.frequencies import LITERAL_RULES, canonical_type
from delayworks.functions.holidays import holiday_name, is_public_holiday
from delayworks.operators import cleaning, features, loans, weather


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_date_from_parts_is_null_for_bad_parts(spark):
    rows = [(2024, 2, 29), (2023, 2, 29), (2024, 13, 1), (None, 1, 1), (2024, 1, None)]
    got = one(spark, rows, "YEAR int, MONTH int, DAY_OF_MONTH int", fn.date_from_parts())
    assert [g[0] for g in got] == [dt.date(2024, 2, 29), None, None, None, None]


def test_tolerant_date(spark):
    rows = [("2024-05-06",), ("2024-05-06 07:08:09.123456",), ("2024-05-06T07:08:09Z",), ("soon",), (None,)]
    got = one(spark, rows, "d string", fn.tolerant_date("d"))
    assert [g[0] for g in got] == [dt.date(2024, 5, 6)] * 3 + [None, None]


def test_three_hour_bucket(spark):
    rows = [("0001-0559",), ("0300-0359",), ("0600-0659",), ("2300-2359",), ("06",), ("xx00-0000",), (None,)]
    got = one(spark, rows, "b string", fn.three_hour_bucket("b"))
    assert [g[0] for g in got] == ["0000-0259", "0300-0559", "0600-0859", "2100-2359", None, None, None]


def test_delay_class_takes_the_worse_delay(spark):
    rows = [(59.9, None), (60.0, 0.0), (0.0, 119.9), (120.0, 5.0), (None, None)]
    got = one(spark, rows, "DEP_DELAY_NEW double, ARR_DELAY_NEW double", fn.delay_class())
    assert [g[0] for g in got] == [0, 1, 1, 2, 0]


def test_flags_treat_null_as_zero(spark):
    got = one(spark, [(None,), (14.9,), (15.0,)], "ARR_DELAY_NEW double", fn.is_delayed_15())
    assert [g[0] for g in got] == [0, 0, 1]


HOLIDAYS = """2023-01-01 2023-01-02 2023-01-16 2023-02-20 2023-05-29 2023-06-19 2023-07-04 2023-09-04 2023-10-09
2023-11-10 2023-11-11 2023-11-23 2023-12-25 2024-01-01 2024-01-15 2024-02-19 2024-05-27 2024-06-19 2024-07-04 2024-09-02
2024-10-14 2024-11-11 2024-11-28 2024-12-25 2025-01-01 2025-01-20 2025-02-17 2025-05-26 2025-06-19 2025-07-04 2025-09-01
2025-10-13 2025-11-11 2025-11-27 2025-12-25""".split()


def test_holidays_of_three_years(spark):
    days = spark.sql("select explode(sequence(date '2023-01-01', date '2025-12-31')) d")
    flagged = days.where(is_public_holiday("d") == 1).select(F.col("d").cast("string")).collect()
    assert sorted(r[0] for r in flagged) == sorted(HOLIDAYS)
    named = days.where(holiday_name("d").isNotNull()).count()
    assert named == len(HOLIDAYS)


def test_observed_new_year_falls_in_the_year_before(spark):
    row = one(spark, [(dt.date(2021, 12, 31),), (None,)], "d date", holiday_name("d"), is_public_holiday("d"))
    assert row == [("New Year's Day (observed)", 1), (None, 0)]


def test_canonical_type_rules(spark):
    rows = [("TWR", "NY TOWER"), ("TWR", None), ("UNIC", "UNICOM RADIO"), ("A/D", None), ("CLD", ""), ("MISC", None)]
    got = one(spark, rows, "freq_type string, description string", canonical_type(), canonical_type(rules=LITERAL_RULES))
    assert [g[0] for g in got] == ["tower", "tower", "ctaf_unicom", "approach_departure", "clearance_delivery", "other"]
    # With word boundaries 'twr_ny_tower' is one word, and 'radio' holds an 'a', 'd' pair.
    assert got[0][1] == "other" and got[2][1] == "approach_departure"


def test_weather_codes_and_missing_values(spark):
    rows = [("S", "2024-01-01T00:00:00", "999,1,N,0055,1", "99999,1,M,N", "016093,1,N,1", "+9999,1", "-0055,C", "10132,1"),
            ("S", "2024-01-01T03:00:00", "010,1,N", "x,1,M,N", "999999,1,7,1", "+0012,1", "+0000,1", "99999,1")]
    df = spark.createDataFrame(rows, "NAME string, DATE string, WND string, CIG string, VIS string, TMP string, DEW string, SLP string")
    first, second = df.transform(weather.with_times).transform(weather.parse_groups).orderBy("time").collect()
    assert first.wind_dir_deg is None and abs(first.wind_speed_mps - 5.5) < 1e-6 and first.ceiling_m is None
    assert first.temp_c is None and abs(first.dewpoint_c + 5.5) < 1e-6 and abs(first.slp_hpa - 1013.2) < 1e-4
    assert second.wind_type is None and second.ceiling_m is None and second.visibility_m is None and second.slp_hpa is None


def test_visibility_code_outside_the_book(spark):
    df = spark.createDataFrame([("N",), ("V",), ("7",), ("Z",), (None,)], "visibility_var_code string")
    df = df.withColumns({"wind_type": F.lit("?"), "ceiling_code": F.lit("W")})
    got = [(r.visibility_var_code_idx, r.wind_type, r.ceiling_code) for r in weather.encode(df).collect()]
    assert got == [(0, 9, 7), (1, 9, 7), (7, 9, 7), (None, 9, 7), (9, 9, 7)]


def test_weather_fill_spans_days_in_time_order(spark):
    rows = [("S", "2024-01-02T03:00:00", 5), ("S", "2024-01-01T21:00:00", 9)]
    full = [(n, d, f"{v:03d},1,N,0010,1", "00100,1,M,N", "000100,1,N,1", "+0010,1", "+0010,1", "10000,1") for n, d, v in rows]
    df = spark.createDataFrame(full, "NAME string, DATE string, WND string, CIG string, VIS string, TMP string, DEW string, SLP string")
    out = weather.silver_weather(df).orderBy("date", "time").collect()
    assert len(out) == 16
    assert [int(r.wind_dir_deg) for r in out] == [9] * 9 + [5] * 7
    assert str(out[0]["date"]) == "2023-12-31" and str(out[0]["T+1_forecast"]) == "2024-01-01"


def test_loan_dates(spark):
    rows = [("1", 100.0, 150.0), ("2", 0.0, 50.0), ("3", 100.0, 0.0)]
    df = spark.createDataFrame(rows, "loan_id string, due_amt double, overdue_amt double").withColumns({
        "installment_num": F.lit(6), "snapshot_date": F.lit("2024-03-31")})
    got = {r.loan_id: (r.installments_missed, r.first_missed_date, r.dpd) for r in loans.loan_silver(df).collect()}
    assert got["1"] == (2, dt.date(2024, 1, 31), 60)
    assert got["2"] == (0, None, None)  # nothing was due: missed 0, no date, unknown days
    assert got["3"] == (0, None, 0)


def test_null_flags_are_dropped_with_cancelled(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (None, 0)], "cancelled int, Diverted int")
    assert df.transform(cleaning.drop_cancelled).count() == 1


def test_volume_counts_flights_with_missing_keys(spark):
    rows = [("C", None, dt.date(2024, 1, 1)), ("C", None, dt.date(2024, 1, 1)), ("C", None, dt.date(2024, 1, 2)), ("C", "JFK", None)]
    df = spark.createDataFrame(rows, "OP_UNIQUE_CARRIER string, ORIGIN string, FlightDate date")
    got = sorted((str(r.ORIGIN), str(r.FlightDate), r.daily_flights, r.volume_zscore) for r in features.attach_volume(df).collect())
    assert got == [("JFK", "None", 1, 0.0), ("None", "2024-01-01", 2, 0.0), ("None", "2024-01-01", 2, 0.0), ("None", "2024-01-02", 1, 0.0)]


def test_volume_score_without_spread_is_zero(spark):
    rows = [("C", "JFK", dt.date(2024, 1, 1))] * 3
    df = spark.createDataFrame(rows, "OP_UNIQUE_CARRIER string, ORIGIN string, FlightDate date")
    assert {(r.daily_flights, r.volume_zscore) for r in features.attach_volume(df).collect()} == {(3, 0.0)}
