"""Profiles of tables."""

from __future__ import annotations

from delayworks.operators import profile, ranking
from delayworks.plans import fixtures as fx
from delayworks.plans.catalog import flights as fl
from delayworks.plans.catalog.io import dated
from delayworks.plans.oracle import FLIGHT_COLUMNS, KEY, sql
from delayworks.plans.registry import query

DELAYS = ("DEP_DELAY_NEW", "ARR_DELAY_NEW", "ACTUAL_ELAPSED_TIME", "DISTANCE")
NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("table_profile", sql("SELECT count(*) AS n_rows, min(FlightDate) AS min_date, max(FlightDate) AS max_date FROM bronze", "bronze"))
def table_profile(spark, d):
    return profile.table_profile(fl.bronze(spark, d), "FlightDate")


@query("null_report", sql(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count(\"{c}\") AS n_null, round(100.0 * count(\"{c}\") / count(*), 6) AS coverage_pct FROM flights"
        for c in FLIGHT_COLUMNS) + ") ORDER BY n_null DESC, \"column\" LIMIT 20", "flights"))
def null_report(spark, d):
    return profile.null_report(fx.flights(spark, d))


@query("counts_by_day", "SELECT CAST(ts AS DATE) AS period, count(*) AS n_rows FROM events GROUP BY 1")
def counts_by_day(spark, d):
    return profile.counts_by(fx.table(spark, d, "events"), "ts", "DD")


@query("counts_by_month", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, count(*) AS n_rows FROM orders GROUP BY 1")
def counts_by_month(spark, d):
    return profile.counts_by(fx.table(spark, d, "orders"), "o_orderdate", "MM")


@query("top_values", sql("""
    SELECT TAIL_NUM, count(*) AS n_rows FROM flights WHERE TAIL_NUM IS NOT NULL GROUP BY TAIL_NUM ORDER BY n_rows DESC, TAIL_NUM LIMIT 10""", "flights"))
def top_values(spark, d):
    return profile.top_values(fx.flights(spark, d), "TAIL_NUM", 10)


@query("day_category_pivot", """
    WITH top AS (SELECT event_type FROM events WHERE event_type IS NOT NULL GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 3),
    names AS (SELECT event_type, row_number() OVER (ORDER BY event_type) AS i FROM top)
    SELECT CAST(ts AS DATE) AS day, count(*) FILTER (WHERE i = 1) AS n_first, count(*) FILTER (WHERE i = 2) AS n_second,
           count(*) FILTER (WHERE i = 3) AS n_third FROM events LEFT JOIN names USING (event_type) GROUP BY 1""")
def day_category_pivot(spark, d):
    wide = profile.day_category_pivot(fx.table(spark, d, "events"), "ts", "event_type", 3)
    return wide.toDF("day", "n_first", "n_second", "n_third")


@query("numeric_summary", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
           CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(quantile_cont({c}, 0.25), 6) AS q25,
           round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75 FROM lineitem""" for c in NUMBERS))
def numeric_summary(spark, d):
    return profile.numeric_summary(fx.table(spark, d, "lineitem"), NUMBERS)


@query("numeric_summary_flights", sql(" UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
           CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,
           round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75
    FROM flights""" for c in DELAYS), "flights"))
def numeric_summary_flights(spark, d):
    return profile.numeric_summary(fx.flights(spark, d), DELAYS)


@query("correlation_matrix", sql(" UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM flights" for a in DELAYS for b in DELAYS), "flights"))
def correlation_matrix(spark, d):
    return profile.correlation_matrix(fx.flights(spark, d), DELAYS)


@query("schema_report", sql(" UNION ALL ".join(
    f"SELECT {i + 1} AS \"position\", '{c}' AS \"column\", '{t}' AS type, 'flight' AS column_group, count(\"{c}\") AS n_values FROM flights"
    for i, (c, t) in enumerate(zip(FLIGHT_COLUMNS, (
        "int", "int", "int", "string", "int", "string", "string", "string", "int", "int", "string", "string",
        "double", "double", "int", "int", "string", "double", "int")))), "flights"))
def schema_report(spark, d):
    return profile.schema_report(fx.flights(spark, d))


@query("head_rows", sql("""
    SELECT FlightDate, OP_UNIQUE_CARRIER, OP_CARRIER_FL_NUM, ORIGIN, DEST, CRS_DEP_TIME, CRS_ARR_TIME FROM dated
    ORDER BY ALL LIMIT 20""", "dated"))
def head_rows(spark, d):
    columns = ["FlightDate", "OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST", "CRS_DEP_TIME", "CRS_ARR_TIME"]
    return profile.head_rows(dated(spark, d).select(*columns), columns, 20)


@query("bounded_sample", sql(f"""
    SELECT {', '.join(KEY)} FROM deduped ORDER BY md5(concat_ws('|', {', '.join(KEY)})) LIMIT 1000""", "deduped"))
def bounded_sample(spark, d):
    from delayworks.operators.cleaning import dedupe_flights
    from delayworks.sources.staging import stage
    rows = stage(dedupe_flights(fl.bronze(spark, d)).select(*KEY), "rows")
    return ranking.bounded_sample(rows, list(KEY), 1000)
