"""SQL for the checks: the fixture tables and the layers as named subqueries.

Written on its own terms (calendar tables, joins and windows on whole tables), so that
it shares no logic with the jobs it checks.
"""

from __future__ import annotations

FLIGHT_COLUMNS = (
    "YEAR", "MONTH", "DAY_OF_MONTH", "OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST", "TAIL_NUM",
    "CRS_DEP_TIME", "CRS_ARR_TIME", "DEP_TIME_BLK", "ARR_TIME_BLK", "DEP_DELAY_NEW", "ARR_DELAY_NEW",
    "CANCELLED", "DIVERTED", "CANCELLATION_CODE", "ACTUAL_ELAPSED_TIME", "DISTANCE",
)
DERIVED = ("source_file", "FlightDate", "year_month", "sort_time", "is_delayed_15", "DayOfWeek", "IsWeekend", "IsPublicHoliday")
KEY = ("FlightDate", "OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST", "CRS_DEP_TIME")
METRO = "('JFK', 'LGA', 'EWR')"
WEATHER_VALUES = (
    "wind_dir_deg", "wind_type", "wind_speed_mps", "ceiling_m", "ceiling_code", "visibility_m",
    "visibility_var_code", "temp_c", "dewpoint_c", "slp_hpa",
)
WEATHER_FEATURES = (*WEATHER_VALUES, "visibility_var_code_idx")
GOLD_DROPPED = ("CANCELLED", "DIVERTED", "CANCELLATION_CODE", "source_file", "is_delayed_15", "sort_time")
SILVER_COLUMNS = (*FLIGHT_COLUMNS, *DERIVED)
GOLD_BASE = tuple(c for c in SILVER_COLUMNS if c not in GOLD_DROPPED)
GOLD_NEW = ("IS_DELAYED", "dep_3hour_col", "arr_3hour_col", "daily_flights", "volume_zscore", "flight_id",
            "is_rare", "is_abnormal_num", "is_peak_day", "is_extra_candidate")
GOLD_COLUMNS = (*GOLD_BASE, "snapshot_date", *GOLD_NEW)


def _cols(names, prefix="") -> str:
    return ", ".join(f'{prefix}"{c}"' for c in names)


def ties(columns) -> str:
    """Order over the non-key columns, taken by name, nulls first."""
    return ", ".join(f'"{c}" ASC NULLS FIRST' for c in sorted(c for c in columns if c not in KEY))


def _airport(x: str) -> str:
    return (f"CASE {x} % 6 WHEN 0 THEN 'JFK' WHEN 1 THEN 'LGA' WHEN 2 THEN 'EWR' WHEN 3 THEN 'BOS' "
            f"WHEN 4 THEN 'ORD' ELSE 'ATL' END")


def _block(h: str) -> str:
    two = f"lpad(CAST({h} AS VARCHAR), 2, '0')"
    return f"CASE WHEN {h} < 6 THEN '0001-0559' ELSE {two} || '00-' || {two} || '59' END"


def bucket(c: str) -> str:
    arms = " ".join(
        f"WHEN CAST(substr({c}, 1, 2) AS INT) < {h + 3} THEN '{h:02d}00-{h + 2:02d}59'" for h in range(0, 24, 3))
    return f"CASE WHEN {c} IS NULL THEN NULL {arms} END"


_QUALITY = " AND ".join(
    [f"{c} IN ('1', '5')" for c in ("wind_dir_qc", "wind_speed_qc", "ceiling_qc", "visibility_qc", "slp_qc")]
    + [f"{c} IN ('1', '5', 'I', 'C')" for c in ("temp_qc", "dewpoint_qc")])


def _masked(group: str, position: int, least: int, missing: int) -> str:
    return (f"CASE WHEN len(string_split({group}, ',')) >= {least} THEN "
            f"nullif(TRY_CAST(string_split({group}, ',')[{position + 1}] AS INT), {missing}) END")


def _part(group: str, position: int, least: int) -> str:
    return f"CASE WHEN len(string_split({group}, ',')) >= {least} THEN string_split({group}, ',')[{position + 1}] END"


def _fill(c: str) -> str:
    over = "PARTITION BY NAME ORDER BY d, t ROWS BETWEEN"
    return (f"coalesce(last_value({c} IGNORE NULLS) OVER ({over} UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({c} IGNORE NULLS) OVER ({over} CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}")


_FREQ_KINDS = ("TWR", "GND", "APP", "DEP", "A/D", "ATIS", "AWOS", "CTAF", "CLD", "FSS", "CNTR", "MISC", "UNIC", "RCO")
_WORST = "greatest(q * 4 - 40, 0, CASE WHEN k % 17 = 0 THEN 0 ELSE q * 4.5 - 50 END)"


def _bonus(c: int) -> str:
    return f"CASE WHEN k % 3 = 0 AND y = {c} THEN 4 ELSE 0 END"


# name -> (needed views, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "lines": ((), """
        SELECT l_orderkey AS k, l_partkey AS p, l_suppkey AS s, CAST(l_linenumber AS BIGINT) AS n,
               l_quantity AS q, CAST(l_shipdate AS DATE) AS d FROM lineitem"""),
    "flights": (("lines",), f"""
        SELECT CAST(year(d) AS INT) AS YEAR, CAST(month(d) AS INT) AS MONTH, CAST(day(d) AS INT) AS DAY_OF_MONTH,
               'C' || CAST(s % 10 AS VARCHAR) AS OP_UNIQUE_CARRIER,
               CAST((p * 41) % 9000 AS INT) AS OP_CARRIER_FL_NUM,
               {_airport('s')} AS ORIGIN, {_airport('p')} AS DEST,
               ' n' || CAST(s AS VARCHAR) || 'ab ' AS TAIL_NUM,
               CAST((k % 24) * 100 + (n * 7) % 60 AS INT) AS CRS_DEP_TIME,
               CAST(((k + 3) % 24) * 100 + (n * 11) % 60 AS INT) AS CRS_ARR_TIME,
               {_block('(k % 24)')} AS DEP_TIME_BLK,
               CASE WHEN k % 41 = 0 THEN NULL ELSE {_block('((k + 3) % 24)')} END AS ARR_TIME_BLK,
               CAST(greatest(q * 4 - 40, 0) + extra AS DOUBLE) AS DEP_DELAY_NEW,
               CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(greatest(q * 4.5 - 50, 0) + extra AS DOUBLE) END AS ARR_DELAY_NEW,
               CASE WHEN k % 211 = 0 THEN NULL WHEN k % 37 = 0 THEN 1 ELSE 0 END AS CANCELLED,
               CASE WHEN p % 53 = 0 THEN 1 ELSE 0 END AS DIVERTED,
               CASE WHEN k % 37 = 0 THEN 'a' END AS CANCELLATION_CODE,
               CASE WHEN k % 101 = 0 THEN CAST(1500 AS DOUBLE) WHEN k % 103 = 0 THEN -5 WHEN k % 107 = 0 THEN NULL
                    ELSE CAST(60 + q * 5 AS DOUBLE) END AS ACTUAL_ELAPSED_TIME,
               CAST(CASE WHEN p % 97 = 0 THEN 6500 ELSE 200 + p % 2000 END AS INT) AS DISTANCE
        FROM (SELECT *, 0 AS extra FROM lines UNION ALL SELECT *, 1 FROM lines WHERE k % 29 = 0)"""),
    "dated": (("flights",), "SELECT *, make_date(YEAR, MONTH, DAY_OF_MONTH) AS FlightDate FROM flights"),
    "holidays": (("lines",), """
        SELECT name AS holiday_name, h AS holiday_date FROM (
          WITH years AS (SELECT unnest(generate_series((SELECT min(year(d)) FROM lines) - 1,
                                                       (SELECT max(year(d)) FROM lines) + 1)) AS y),
          fixed AS (
            SELECT name, make_date(y, m, dd) AS h FROM years, (VALUES
              ('New Year''s Day', 1, 1, 1), ('Juneteenth National Independence Day', 6, 19, 2021),
              ('Independence Day', 7, 4, 1), ('Veterans Day', 11, 11, 1), ('Christmas Day', 12, 25, 1)
            ) r(name, m, dd, since) WHERE y >= since),
          floating AS (
            SELECT name, CAST(make_date(y, m, 1)
                 + CAST((dow - dayofweek(make_date(y, m, 1)) + 7) % 7 + 7 * (nth - 1) AS INT) AS DATE) AS h
            FROM years, (VALUES
              ('Martin Luther King Jr. Day', 1, 1, 3, 1986), ('Washington''s Birthday', 2, 1, 3, 1),
              ('Labor Day', 9, 1, 1, 1), ('Columbus Day', 10, 1, 2, 1), ('Thanksgiving Day', 11, 4, 4, 1)
            ) r(name, m, dow, nth, since) WHERE y >= since
            UNION ALL
            SELECT 'Memorial Day', CAST(make_date(y, 5, 31) - CAST((dayofweek(make_date(y, 5, 31)) + 6) % 7 AS INT) AS DATE)
            FROM years)
          SELECT name, h FROM fixed UNION ALL SELECT name, h FROM floating
          UNION ALL SELECT name || ' (observed)', CAST(h + 1 AS DATE) FROM fixed WHERE dayofweek(h) = 0
          UNION ALL SELECT name || ' (observed)', CAST(h - 1 AS DATE) FROM fixed WHERE dayofweek(h) = 6)"""),
    "bronze": (("dated", "holidays"), f"""
        SELECT {_cols(FLIGHT_COLUMNS)},
               'T_ONTIME_REPORTING-' || strftime(FlightDate, '%m_%y') || '.csv' AS source_file, FlightDate,
               strftime(FlightDate, '%Y-%m') AS year_month,
               CASE WHEN ORIGIN IN {METRO} THEN CRS_DEP_TIME ELSE CRS_ARR_TIME END AS sort_time,
               CASE WHEN ARR_DELAY_NEW >= 15 THEN 1 ELSE 0 END AS is_delayed_15,
               CAST(dayofweek(FlightDate) + 1 AS INT) AS DayOfWeek,
               CASE WHEN dayofweek(FlightDate) IN (0, 6) THEN 1 ELSE 0 END AS IsWeekend,
               CASE WHEN FlightDate IN (SELECT holiday_date FROM holidays) THEN 1 ELSE 0 END AS IsPublicHoliday
        FROM dated WHERE ORIGIN IN {METRO} OR DEST IN {METRO}"""),
    "deduped": (("bronze",), f"""
        SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY {_cols(KEY)} ORDER BY {ties(SILVER_COLUMNS)}) = 1"""),
    "silver": (("deduped",), """
        SELECT * REPLACE (trim(upper(TAIL_NUM)) AS TAIL_NUM, trim(upper(CANCELLATION_CODE)) AS CANCELLATION_CODE)
        FROM deduped
        WHERE CANCELLED <> 1 AND DIVERTED <> 1
          AND (ACTUAL_ELAPSED_TIME IS NULL OR (ACTUAL_ELAPSED_TIME <= 1440 AND ACTUAL_ELAPSED_TIME >= 0))
          AND (DISTANCE IS NULL OR DISTANCE <= 6000)"""),
    "volume": (("silver",), """
        SELECT *, avg(daily_flights) OVER (PARTITION BY OP_UNIQUE_CARRIER, ORIGIN) AS mean_flights,
               stddev_samp(daily_flights) OVER (PARTITION BY OP_UNIQUE_CARRIER, ORIGIN) AS stddev_flights
        FROM (SELECT *, count(*) OVER (PARTITION BY OP_UNIQUE_CARRIER, ORIGIN, FlightDate) AS daily_flights,
                     count(*) OVER (PARTITION BY OP_UNIQUE_CARRIER, OP_CARRIER_FL_NUM) AS flight_count FROM silver)"""),
    "scored_volume": (("volume",), """
        SELECT *, round(CASE WHEN stddev_flights > 0 THEN (daily_flights - mean_flights) / stddev_flights ELSE 0 END, 6)
               AS volume_zscore FROM volume"""),
    "gold_parts": (("scored_volume",), f"""
        SELECT *, FlightDate AS snapshot_date,
               CASE WHEN greatest(coalesce(DEP_DELAY_NEW, 0), coalesce(ARR_DELAY_NEW, 0)) >= 120 THEN 2
                    WHEN greatest(coalesce(DEP_DELAY_NEW, 0), coalesce(ARR_DELAY_NEW, 0)) >= 60 THEN 1 ELSE 0 END AS IS_DELAYED,
               {bucket('DEP_TIME_BLK')} AS dep_3hour_col, {bucket('ARR_TIME_BLK')} AS arr_3hour_col,
               OP_UNIQUE_CARRIER || '_' || CAST(OP_CARRIER_FL_NUM AS VARCHAR) AS flight_id,
               CASE WHEN flight_count < 3 THEN 1 ELSE 0 END AS is_rare,
               CASE WHEN OP_CARRIER_FL_NUM > 8000 THEN 1 ELSE 0 END AS is_abnormal_num,
               CASE WHEN volume_zscore > 2 THEN 1 ELSE 0 END AS is_peak_day
        FROM scored_volume"""),
    "gold": (("gold_parts",), f"""
        SELECT {_cols(c for c in GOLD_COLUMNS if c != 'is_extra_candidate')},
               CASE WHEN is_rare = 1 OR is_abnormal_num = 1 THEN 1 ELSE 0 END AS is_extra_candidate FROM gold_parts"""),
    "raw_weather": ((), """
        SELECT CASE o_custkey % 4 WHEN 0 THEN 'JFK INTERNATIONAL AIRPORT, NY US' WHEN 1 THEN 'LAGUARDIA AIRPORT, NY US'
                 WHEN 2 THEN 'NEWARK LIBERTY INTERNATIONAL AIRPORT, NJ US' ELSE 'OTHER FIELD, NY US' END AS NAME,
               strftime(o_orderdate, '%Y-%m-%d') || 'T' || lpad(CAST((ok % 8) * 3 AS VARCHAR), 2, '0') || ':'
                 || CASE WHEN ok % 7 = 0 THEN '51' ELSE '00' END || ':00' AS DATE,
               CASE WHEN ok % 11 = 0 THEN '999' ELSE lpad(CAST(ok % 360 AS VARCHAR), 3, '0') END || ','
                 || CASE WHEN ok % 13 = 0 THEN '3' ELSE '1' END || ','
                 || CASE ok % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'C' WHEN 2 THEN 'V' ELSE '9' END || ','
                 || lpad(CAST(ok % 300 AS VARCHAR), 4, '0') || ',1' AS WND,
               CASE WHEN ok % 19 = 0 THEN '99999' ELSE lpad(CAST((ok * 7) % 22000 AS VARCHAR), 5, '0') END || ',1,'
                 || CASE ok % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'W' ELSE '9' END || ',N' AS CIG,
               CASE WHEN ok % 23 = 0 THEN '999999' ELSE lpad(CAST((ok * 13) % 16000 AS VARCHAR), 6, '0') END || ',1,'
                 || CASE ok % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'V' ELSE '9' END || ',1' AS VIS,
               CASE WHEN ok % 31 = 0 THEN '+9999' ELSE CASE WHEN ok % 400 < 100 THEN '-' ELSE '+' END
                 || lpad(CAST(abs(ok % 400 - 100) AS VARCHAR), 4, '0') END || ',1' AS TMP,
               CASE WHEN ok % 31 = 0 THEN '+9999' ELSE CASE WHEN ok % 300 < 100 THEN '-' ELSE '+' END
                 || lpad(CAST(abs(ok % 300 - 100) AS VARCHAR), 4, '0') END || ',C' AS DEW,
               CASE WHEN ok % 17 = 0 THEN '99999' ELSE lpad(CAST(9900 + ok % 400 AS VARCHAR), 5, '0') END || ',1' AS SLP
        FROM (SELECT *, o_orderkey AS ok FROM orders)"""),
    "timed": (("raw_weather",), """
        SELECT NAME, WND, CIG, VIS, TMP, DEW, SLP, CAST("DATE" AS TIMESTAMP) AS ts,
               CAST(CAST("DATE" AS TIMESTAMP) AS DATE) AS d, strftime(CAST("DATE" AS TIMESTAMP), '%H:%M') AS t FROM raw_weather"""),
    "latest": (("timed",), """
        SELECT * FROM timed QUALIFY row_number() OVER (PARTITION BY NAME, d, t ORDER BY ts DESC,
               WND NULLS FIRST, CIG NULLS FIRST, VIS NULLS FIRST, TMP NULLS FIRST, DEW NULLS FIRST, SLP NULLS FIRST) = 1"""),
    "parsed": (("latest",), f"""
        SELECT *, CAST({_masked('WND', 0, 5, 999)} AS FLOAT) AS wind_dir_deg, {_part('WND', 2, 5)} AS wind_type,
               CAST({_masked('WND', 3, 5, 9999)} / 10.0 AS FLOAT) AS wind_speed_mps,
               {_part('WND', 1, 5)} AS wind_dir_qc, {_part('WND', 4, 5)} AS wind_speed_qc,
               CAST({_masked('CIG', 0, 4, 99999)} AS FLOAT) AS ceiling_m, {_part('CIG', 2, 4)} AS ceiling_code,
               {_part('CIG', 1, 4)} AS ceiling_qc,
               CAST({_masked('VIS', 0, 4, 999999)} AS FLOAT) AS visibility_m, {_part('VIS', 2, 4)} AS visibility_var_code,
               {_part('VIS', 1, 4)} AS visibility_qc,
               CAST({_masked('TMP', 0, 2, 9999)} / 10.0 AS FLOAT) AS temp_c, {_part('TMP', 1, 2)} AS temp_qc,
               CAST({_masked('DEW', 0, 2, 9999)} / 10.0 AS FLOAT) AS dewpoint_c, {_part('DEW', 1, 2)} AS dewpoint_qc,
               CAST({_masked('SLP', 0, 2, 99999)} / 10.0 AS FLOAT) AS slp_hpa, {_part('SLP', 1, 2)} AS slp_qc
        FROM latest"""),
    "accepted": (("parsed",), f"SELECT * FROM parsed WHERE {_QUALITY}"),
    "grid": (("accepted",), f"""
        SELECT g.NAME, g.d, g.t, {_cols(WEATHER_VALUES, 'a.')}
        FROM (SELECT DISTINCT NAME, d, s.t FROM accepted, (VALUES ('00:00'), ('03:00'), ('06:00'), ('09:00'),
              ('12:00'), ('15:00'), ('18:00'), ('21:00')) s(t)) g
        LEFT JOIN accepted a ON a.NAME = g.NAME AND a.d = g.d AND a.t = g.t"""),
    "filled": (("grid",), f"SELECT NAME, d, t, {', '.join(_fill(c) for c in WEATHER_VALUES)} FROM grid"),
    "encoded": (("filled",), f"""
        SELECT d, t, CASE NAME WHEN 'JFK INTERNATIONAL AIRPORT, NY US' THEN 'JFK' WHEN 'LAGUARDIA AIRPORT, NY US' THEN 'LGA'
                 WHEN 'NEWARK LIBERTY INTERNATIONAL AIRPORT, NJ US' THEN 'EWR' END AS NAME,
               wind_dir_deg,
               CASE wind_type WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 WHEN 'H' THEN 3 WHEN 'N' THEN 4
                 WHEN 'R' THEN 5 WHEN 'Q' THEN 6 WHEN 'T' THEN 7 WHEN 'V' THEN 8 ELSE 9 END AS wind_type,
               wind_speed_mps, ceiling_m,
               CASE ceiling_code WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 WHEN 'E' THEN 3 WHEN 'M' THEN 4
                 WHEN 'R' THEN 5 WHEN 'S' THEN 6 WHEN 'W' THEN 7 ELSE 9 END AS ceiling_code,
               visibility_m, visibility_var_code, temp_c, dewpoint_c, slp_hpa,
               CASE WHEN visibility_var_code = 'N' THEN 0 WHEN visibility_var_code = 'V' THEN 1
                 WHEN visibility_var_code IS NULL THEN 9 ELSE TRY_CAST(visibility_var_code AS INT) END AS visibility_var_code_idx
        FROM filled"""),
    "silver_weather": (("encoded",), f"""
        SELECT NAME AS name, CAST(d - 1 AS DATE) AS "date", replace(t, ':', '') AS "time", d AS "T+1_forecast",
               {_cols(WEATHER_FEATURES)} FROM encoded"""),
    "legs": (("gold",), f"""
        SELECT *, 'dep' AS leg, ORIGIN AS wa, substr(dep_3hour_col, 1, 4) AS wt FROM gold WHERE ORIGIN IN {METRO}
        UNION ALL
        SELECT *, 'arr', DEST, substr(arr_3hour_col, 1, 4) FROM gold WHERE DEST IN {METRO}"""),
    "combined": (("legs", "silver_weather"), f"""
        SELECT {_cols(GOLD_COLUMNS, 'l.')}, l.leg, {', '.join(f'w."{c}" AS "weather_{c}"' for c in WEATHER_FEATURES)}
        FROM legs l LEFT JOIN silver_weather w ON w."date" = l.FlightDate AND w.name = l.wa AND w."time" = l.wt"""),
    "fx_airports": ((), """
        SELECT c_custkey AS id, 'k' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') || ' ' AS ident,
               lower(c_mktsegment) AS type, c_name AS name,
               CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey % 90 AS DOUBLE) END AS latitude_deg,
               CAST(c_custkey % 180 AS DOUBLE) AS longitude_deg, CAST(c_custkey % 3000 AS INT) AS elevation_ft,
               'NA' AS continent, CASE WHEN c_custkey % 3 <> 0 THEN 'us' ELSE 'CA' END AS iso_country,
               'R-' || CAST(c_nationkey AS VARCHAR) AS iso_region, 'City ' || CAST(c_nationkey AS VARCHAR) AS municipality,
               CASE c_custkey % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'NO' WHEN 2 THEN '' WHEN 3 THEN ' Yes' END AS scheduled_service,
               CASE c_custkey WHEN 1 THEN 'JFK' WHEN 2 THEN 'LGA' WHEN 4 THEN 'EWR' END AS iata_code
        FROM customer"""),
    "us_airports": (("fx_airports",), """
        SELECT id AS airport_id, ident, upper(trim(ident)) AS ident_norm, name, type AS airport_type, municipality,
               iso_country, iso_region, continent, latitude_deg, longitude_deg, elevation_ft,
               CASE upper(trim(scheduled_service)) WHEN 'YES' THEN true WHEN 'NO' THEN false END AS scheduled_service_bool,
               latitude_deg IS NOT NULL AND longitude_deg IS NOT NULL AS has_geo
        FROM fx_airports WHERE upper(trim(iso_country)) = 'US'"""),
    "fx_freqs": ((), f"""
        SELECT ok AS id, ck AS airport_ref,
               CASE WHEN ok % 7 = 0 THEN 'ZZZ' ELSE 'K' || lpad(CAST(ck AS VARCHAR), 5, '0') END AS airport_ident,
               CASE ok % 14 {' '.join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_FREQ_KINDS))} END AS type,
               CASE ok % 4 WHEN 1 THEN 'NY TOWER' WHEN 2 THEN 'APP/DEP' WHEN 3 THEN 'UNICOM RADIO' END AS description,
               CAST(118000 + (ok % 720) * 25 AS DOUBLE) / 1000 AS frequency_mhz
        FROM (SELECT o_orderkey AS ok, o_custkey AS ck FROM orders)"""),
    "core": (("fx_freqs", "us_airports"), r"""
        SELECT *, CASE WHEN upper(trim(airport_ident)) = ident_norm THEN 1 ELSE 0 END AS ident_match,
          CASE WHEN regexp_matches(w, '(^|[^a-z0-9])(twr|tower)([^a-z0-9]|$)') THEN 'tower'
               WHEN regexp_matches(w, '(^|[^a-z0-9])(gnd|ground)([^a-z0-9]|$)') THEN 'ground'
               WHEN regexp_matches(w, '(^|[^a-z0-9])(app|appr|aprch|approach)([^a-z0-9]|$)') THEN 'approach'
               WHEN regexp_matches(w, '(^|[^a-z0-9])(dep|dept|departure)([^a-z0-9]|$)') THEN 'departure'
               WHEN regexp_matches(w, '(^|[^a-z0-9])a[_/]*d([^a-z0-9]|$)') THEN 'approach_departure'
               WHEN regexp_matches(w, '(^|[^a-z0-9])(d[_]*atis|atis)([^a-z0-9]|$)') THEN 'atis'
               WHEN regexp_matches(w, '(^|[^a-z0-9])(awos|wx[_]*asos|wxas|asos)([^a-z0-9]|$)') THEN 'awos'
               WHEN w LIKE '%ctaf%' OR w LIKE '%unicom%' THEN 'ctaf_unicom'
               WHEN w LIKE '%cld%' OR w LIKE '%clr%' OR regexp_matches(w, 'clnc_*del') OR w LIKE '%clearance%'
                 THEN 'clearance_delivery'
               WHEN regexp_matches(w, '(^|[^a-z0-9])(fss|rfss|rco)([^a-z0-9]|$)') THEN 'fss'
               WHEN regexp_matches(w, '(^|[^a-z0-9])(cntr|ctr|center)([^a-z0-9]|$)') THEN 'center'
               ELSE 'other' END AS canonical_type
        FROM (SELECT f.id AS freq_id, f.airport_ref, f.airport_ident, f.type AS freq_type, f.description, f.frequency_mhz,
                     lower(regexp_replace(f.type || ' ' || coalesce(f.description, ''), '[\s\-]+', '_', 'g')) AS w, a.*
              FROM fx_freqs f JOIN us_airports a ON a.airport_id = f.airport_ref)"""),
    "fx_loans": (("lines",), """
        SELECT CAST(k AS VARCHAR) AS loan_id, CAST(o_custkey AS VARCHAR) AS Customer_ID,
               CAST(o_orderdate AS DATE) AS loan_start_date, 10 AS tenure, CAST(n + k % 6 AS INT) AS installment_num,
               CAST(1000 AS FLOAT) AS loan_amt, CAST(CASE WHEN k % 61 = 0 THEN 0 ELSE 100 END AS FLOAT) AS due_amt,
               CAST(CASE WHEN k % 43 = 0 THEN NULL ELSE q * 2 END AS FLOAT) AS paid_amt,
               CAST((k % 5) * 60 AS FLOAT) AS overdue_amt, CAST(1000 - q * 2 AS FLOAT) AS balance,
               CAST(date_trunc('month', d) AS DATE) AS snapshot_date
        FROM lines JOIN orders ON o_orderkey = k"""),
    "loan_missed": (("fx_loans",), """
        SELECT * REPLACE (coalesce(paid_amt, 0) AS paid_amt), installment_num AS mob,
               CASE WHEN due_amt = 0 THEN 0 ELSE CAST(ceil(overdue_amt / due_amt) AS INT) END AS installments_missed
        FROM fx_loans"""),
    "loan_first": (("loan_missed",), """
        SELECT *, CASE WHEN installments_missed > 0 THEN
               CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date FROM loan_missed"""),
    "loan_silver": (("loan_first",), """
        SELECT *, CASE WHEN overdue_amt > 0 THEN CAST(date_diff('day', first_missed_date, snapshot_date) AS INT) ELSE 0 END AS dpd
        FROM loan_first"""),
    "fx_features": ((), """
        SELECT o_orderkey AS feature_id, CAST(o_custkey AS VARCHAR) AS Customer_ID,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS label_snapshot_date,
               CASE o_custkey % 5 WHEN 0 THEN 'Lawyer' WHEN 1 THEN 'Doctor' WHEN 2 THEN 'Teacher' WHEN 3 THEN 'Writer' END AS Occupation,
               CASE o_custkey % 3 WHEN 0 THEN '18-30' WHEN 1 THEN '31-50' ELSE '51+' END AS Age_bin,
               CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 100 AS VARCHAR) END AS fe_1,
               CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_totalprice END AS fe_2,
               CAST((o_orderkey * 7) % 1000 AS INT) AS fe_3 FROM orders"""),
    "fx_labels": (("lines",), """
        SELECT CAST(o_custkey AS VARCHAR) AS Customer_ID, CAST(date_trunc('month', d) AS DATE) AS snapshot_date,
               CASE WHEN k % 17 = 0 THEN NULL WHEN k % 4 = 0 THEN 1 ELSE 0 END AS label, k * 10 + n AS load_order
        FROM lines JOIN orders ON o_orderkey = k"""),
    "last_labels": (("fx_labels",), """
        SELECT * FROM fx_labels QUALIFY row_number() OVER (PARTITION BY Customer_ID, snapshot_date
               ORDER BY load_order DESC, label DESC NULLS LAST) = 1"""),
    "fx_scores": ((), """
        SELECT CAST(o_custkey AS VARCHAR) AS Customer_ID, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
               CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_orderkey % 19 AS DOUBLE) / 19 END AS default_proba,
               o_orderkey % 50 AS run_id FROM orders"""),
    "fx_runs": ((), """
        SELECT c_custkey AS run_id, CASE WHEN c_custkey % 9 = 0 THEN 'FAILED' ELSE 'FINISHED' END AS status,
               CAST(DATE '2023-01-01' + to_months(CAST(c_custkey % 24 AS INT)) AS DATE) AS train_date,
               CAST(DATE '2025-01-01' + CAST((c_custkey * 37) % 1000 AS INT) AS DATE) AS start_time,
               CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal / 10000 END AS metric_value,
               CAST(50 + c_custkey % 50 AS DOUBLE) / 100 AS auc_test FROM customer"""),
    "preds": (("lines",), f"""
        SELECT k, p, s, n, y AS IS_DELAYED, w0 / (w0 + w1 + w2) AS proba_0, w1 / (w0 + w1 + w2) AS proba_1,
               w2 / (w0 + w1 + w2) AS proba_2, CAST(DATE '2025-01-01' + CAST(k % 40 AS INT) AS DATE) AS snapshot_date,
               'C' || CAST(s % 10 AS VARCHAR) || '_' || CAST((p * 41) % 9000 AS VARCHAR) AS flight_id,
               CASE WHEN w0 >= w1 AND w0 >= w2 THEN 0 WHEN w1 >= w2 THEN 1 ELSE 2 END AS pred_class
        FROM (SELECT *, CAST(1 + k % 7 + {_bonus(0)} AS DOUBLE) AS w0, CAST(1 + p % 5 + {_bonus(1)} AS DOUBLE) AS w1,
                     CAST(1 + n % 3 + {_bonus(2)} AS DOUBLE) AS w2
              FROM (SELECT *, CASE WHEN {_WORST} >= 120 THEN 2 WHEN {_WORST} >= 60 THEN 1 ELSE 0 END AS y FROM lines))"""),
}


def sql(select: str, *views: str) -> str:
    """A statement over the named views and everything they need."""
    order: list[str] = []

    def need(name: str) -> None:
        if name not in order:
            for other in VIEWS[name][0]:
                need(other)
            order.append(name)

    for view in views:
        need(view)
    with_part = ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in order)
    return f"WITH {with_part}\n{select}" if order else select
