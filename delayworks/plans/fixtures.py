"""Input tables in the shapes the jobs expect, derived row by row from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


AIRPORT_OF = ("CASE {x} % 6 WHEN 0 THEN 'JFK' WHEN 1 THEN 'LGA' WHEN 2 THEN 'EWR' "
              "WHEN 3 THEN 'BOS' WHEN 4 THEN 'ORD' ELSE 'ATL' END")
BLOCK_OF = ("CASE WHEN {h} < 6 THEN '0001-0559' ELSE lpad(cast({h} AS string), 2, '0') || '00-' "
            "|| lpad(cast({h} AS string), 2, '0') || '59' END")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS k", "l_partkey AS p", "l_suppkey AS s", "cast(l_linenumber AS bigint) AS n",
        "l_quantity AS q", "cast(l_shipdate AS date) AS d")


def flights(spark: SparkSession, folder: str) -> DataFrame:
    """Raw flights; some rows come twice, the copy with one more minute of delay."""
    copies = "explode(CASE WHEN k % 29 = 0 THEN array(0, 1) ELSE array(0) END) AS extra"
    return _lines(spark, folder).selectExpr("*", copies).selectExpr(
        "year(d) AS YEAR", "month(d) AS MONTH", "day(d) AS DAY_OF_MONTH",
        "'C' || cast(s % 10 AS string) AS OP_UNIQUE_CARRIER",
        "cast((p * 41) % 9000 AS int) AS OP_CARRIER_FL_NUM",
        AIRPORT_OF.format(x="s") + " AS ORIGIN", AIRPORT_OF.format(x="p") + " AS DEST",
        "' n' || cast(s AS string) || 'ab ' AS TAIL_NUM",
        "cast((k % 24) * 100 + (n * 7) % 60 AS int) AS CRS_DEP_TIME",
        "cast(((k + 3) % 24) * 100 + (n * 11) % 60 AS int) AS CRS_ARR_TIME",
        BLOCK_OF.format(h="(k % 24)") + " AS DEP_TIME_BLK",
        "CASE WHEN k % 41 = 0 THEN NULL ELSE " + BLOCK_OF.format(h="((k + 3) % 24)") + " END AS ARR_TIME_BLK",
        "cast(greatest(q * 4 - 40, 0) + extra AS double) AS DEP_DELAY_NEW",
        "CASE WHEN k % 17 = 0 THEN NULL ELSE cast(greatest(q * 4.5D - 50, 0) + extra AS double) END AS ARR_DELAY_NEW",
        "CASE WHEN k % 211 = 0 THEN NULL WHEN k % 37 = 0 THEN 1 ELSE 0 END AS CANCELLED",
        "CASE WHEN p % 53 = 0 THEN 1 ELSE 0 END AS DIVERTED",
        "CASE WHEN k % 37 = 0 THEN 'a' END AS CANCELLATION_CODE",
        "CASE WHEN k % 101 = 0 THEN 1500D WHEN k % 103 = 0 THEN -5D WHEN k % 107 = 0 THEN NULL "
        "ELSE cast(60 + q * 5 AS double) END AS ACTUAL_ELAPSED_TIME",
        "cast(CASE WHEN p % 97 = 0 THEN 6500 ELSE 200 + p % 2000 END AS int) AS DISTANCE",
    )


def weather(spark: SparkSession, folder: str) -> DataFrame:
    """Raw station observations with their comma-packed groups."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS ok", "o_custkey AS ck", "cast(o_orderdate AS date) AS od").selectExpr(
        "CASE ck % 4 WHEN 0 THEN 'JFK INTERNATIONAL AIRPORT, NY US' WHEN 1 THEN 'LAGUARDIA AIRPORT, NY US' "
        "WHEN 2 THEN 'NEWARK LIBERTY INTERNATIONAL AIRPORT, NJ US' ELSE 'OTHER FIELD, NY US' END AS NAME",
        "cast(od AS string) || 'T' || lpad(cast((ok % 8) * 3 AS string), 2, '0') || ':' "
        "|| CASE WHEN ok % 7 = 0 THEN '51' ELSE '00' END || ':00' AS DATE",
        "CASE WHEN ok % 11 = 0 THEN '999' ELSE lpad(cast(ok % 360 AS string), 3, '0') END || ',' "
        "|| CASE WHEN ok % 13 = 0 THEN '3' ELSE '1' END || ',' "
        "|| CASE ok % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'C' WHEN 2 THEN 'V' ELSE '9' END || ',' "
        "|| lpad(cast(ok % 300 AS string), 4, '0') || ',1' AS WND",
        "CASE WHEN ok % 19 = 0 THEN '99999' ELSE lpad(cast((ok * 7) % 22000 AS string), 5, '0') END || ',1,' "
        "|| CASE ok % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'W' ELSE '9' END || ',N' AS CIG",
        "CASE WHEN ok % 23 = 0 THEN '999999' ELSE lpad(cast((ok * 13) % 16000 AS string), 6, '0') END || ',1,' "
        "|| CASE ok % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'V' ELSE '9' END || ',1' AS VIS",
        "CASE WHEN ok % 31 = 0 THEN '+9999' ELSE CASE WHEN ok % 400 < 100 THEN '-' ELSE '+' END "
        "|| lpad(cast(abs(ok % 400 - 100) AS string), 4, '0') END || ',1' AS TMP",
        "CASE WHEN ok % 31 = 0 THEN '+9999' ELSE CASE WHEN ok % 300 < 100 THEN '-' ELSE '+' END "
        "|| lpad(cast(abs(ok % 300 - 100) AS string), 4, '0') END || ',C' AS DEW",
        "CASE WHEN ok % 17 = 0 THEN '99999' ELSE lpad(cast(9900 + ok % 400 AS string), 5, '0') END || ',1' AS SLP",
    )


def airports(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "c_custkey AS id", "'k' || lpad(cast(c_custkey AS string), 5, '0') || ' ' AS ident",
        "lower(c_mktsegment) AS type", "c_name AS name",
        "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE cast(c_custkey % 90 AS double) END AS latitude_deg",
        "cast(c_custkey % 180 AS double) AS longitude_deg", "cast(c_custkey % 3000 AS int) AS elevation_ft",
        "'NA' AS continent", "CASE WHEN c_custkey % 3 <> 0 THEN 'us' ELSE 'CA' END AS iso_country",
        "'R-' || cast(c_nationkey AS string) AS iso_region", "'City ' || cast(c_nationkey AS string) AS municipality",
        "CASE c_custkey % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'NO' WHEN 2 THEN '' WHEN 3 THEN ' Yes' END AS scheduled_service",
        "CASE c_custkey WHEN 1 THEN 'JFK' WHEN 2 THEN 'LGA' WHEN 4 THEN 'EWR' END AS iata_code",
    )


def frequencies(spark: SparkSession, folder: str) -> DataFrame:
    kinds = ("TWR", "GND", "APP", "DEP", "A/D", "ATIS", "AWOS", "CTAF", "CLD", "FSS", "CNTR", "MISC", "UNIC", "RCO")
    kind = "CASE ok % 14 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(kinds)) + " END"
    return table(spark, folder, "orders").selectExpr("o_orderkey AS ok", "o_custkey AS ck").selectExpr(
        "ok AS id", "ck AS airport_ref",
        "CASE WHEN ok % 7 = 0 THEN 'ZZZ' ELSE 'K' || lpad(cast(ck AS string), 5, '0') END AS airport_ident",
        f"{kind} AS type",
        "CASE ok % 4 WHEN 1 THEN 'NY TOWER' WHEN 2 THEN 'APP/DEP' WHEN 3 THEN 'UNICOM RADIO' END AS description",
        "cast(118000 + (ok % 720) * 25 AS double) / 1000 AS frequency_mhz",
    )


def loans(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").selectExpr("o_orderkey AS k", "o_custkey AS ck", "cast(o_orderdate AS date) AS od")
    return _lines(spark, folder).join(orders, "k").selectExpr(
        "cast(k AS string) AS loan_id", "cast(ck AS string) AS Customer_ID", "od AS loan_start_date", "10 AS tenure",
        "cast(n + k % 6 AS int) AS installment_num", "1000.0 AS loan_amt",
        "CASE WHEN k % 61 = 0 THEN 0.0 ELSE 100.0 END AS due_amt",
        "CASE WHEN k % 43 = 0 THEN NULL ELSE q * 2 END AS paid_amt", "(k % 5) * 60.0 AS overdue_amt",
        "1000.0 - q * 2 AS balance", "trunc(d, 'MM') AS snapshot_date",
    )


def features(spark: SparkSession, folder: str) -> DataFrame:
    """Customer features by month."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS ok", "o_custkey AS ck", "o_totalprice AS t", "trunc(cast(o_orderdate AS date), 'MM') AS m").selectExpr(
        "ok AS feature_id", "cast(ck AS string) AS Customer_ID", "m AS label_snapshot_date",
        "CASE ck % 5 WHEN 0 THEN 'Lawyer' WHEN 1 THEN 'Doctor' WHEN 2 THEN 'Teacher' WHEN 3 THEN 'Writer' END AS Occupation",
        "CASE ck % 3 WHEN 0 THEN '18-30' WHEN 1 THEN '31-50' ELSE '51+' END AS Age_bin",
        "CASE WHEN ok % 9 = 0 THEN 'n/a' ELSE cast(ok % 100 AS string) END AS fe_1",
        "CASE WHEN ok % 8 = 0 THEN NULL ELSE t END AS fe_2", "cast((ok * 7) % 1000 AS int) AS fe_3",
    )


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labels as loaded, with repeated and missing values."""
    orders = table(spark, folder, "orders").selectExpr("o_orderkey AS k", "o_custkey AS ck")
    return _lines(spark, folder).join(orders, "k").selectExpr(
        "cast(ck AS string) AS Customer_ID", "trunc(d, 'MM') AS snapshot_date",
        "CASE WHEN k % 17 = 0 THEN NULL WHEN k % 4 = 0 THEN 1 ELSE 0 END AS label", "k * 10 + n AS load_order",
    )


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of many runs under the names they were written with."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS ok", "o_custkey AS ck", "trunc(cast(o_orderdate AS date), 'MM') AS m").selectExpr(
        "cast(ck AS string) AS Customer_ID", "m AS label_snapshot_date",
        "CASE WHEN ok % 23 = 0 THEN NULL ELSE cast(ok % 19 AS double) / 19 END AS score", "ok % 50 AS run_id",
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "c_custkey AS run_id", "CASE WHEN c_custkey % 9 = 0 THEN 'FAILED' ELSE 'FINISHED' END AS status",
        "add_months(date '2023-01-01', cast(c_custkey % 24 AS int)) AS train_date",
        "date_add(date '2025-01-01', cast((c_custkey * 37) % 1000 AS int)) AS start_time",
        "CASE WHEN c_custkey % 13 = 0 THEN 'NaN-text' ELSE cast(c_acctbal / 10000 AS string) END AS metric",
        "cast(50 + c_custkey % 50 AS double) / 100 AS auc_test",
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Class probabilities with many ties, and the class that came true."""
    worst = "greatest(q * 4 - 40, 0, CASE WHEN k % 17 = 0 THEN 0 ELSE q * 4.5D - 50 END)"
    bonus = lambda c: f"CASE WHEN k % 3 = 0 AND y = {c} THEN 4 ELSE 0 END"
    return (
        _lines(spark, folder)
        .selectExpr("*", f"CASE WHEN {worst} >= 120 THEN 2 WHEN {worst} >= 60 THEN 1 ELSE 0 END AS y")
        .selectExpr("*", f"cast(1 + k % 7 + {bonus(0)} AS double) AS w0", f"cast(1 + p % 5 + {bonus(1)} AS double) AS w1",
                    f"cast(1 + n % 3 + {bonus(2)} AS double) AS w2")
        .selectExpr("k", "p", "s", "n", "y AS IS_DELAYED", "w0 / (w0 + w1 + w2) AS proba_0", "w1 / (w0 + w1 + w2) AS proba_1",
                    "w2 / (w0 + w1 + w2) AS proba_2", "date_add(date '2025-01-01', cast(k % 40 AS int)) AS snapshot_date",
                    "'C' || cast(s % 10 AS string) || '_' || cast((p * 41) % 9000 AS string) AS flight_id")
    )


def with_source_file(flight_rows: DataFrame) -> DataFrame:
    """Name of the monthly file a flight would have been read from."""
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    name = F.concat(F.lit("T_ONTIME_REPORTING-"), two(F.col("MONTH")), F.lit("_"), two(F.col("YEAR") % 100), F.lit(".csv"))
    return flight_rows.withColumn("source_file", name)
