"""Scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from delayworks.functions import flights as fn
from delayworks.operators import cleaning, profile
from delayworks.plans import fixtures as fx
from delayworks.plans import jobs
from delayworks.plans.oracle import sql
from delayworks.plans.registry import query
from delayworks.sources import readers, sinks
from delayworks.sources.staging import scratch_path

ORDERS = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.DateType()), T.StructField("o_orderpriority", T.StringType()),
])
CUSTOMER = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])
ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
                o_orderpriority FROM orders"""


def orders(spark, d):
    return fx.table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def dated(spark, d):
    return fx.flights(spark, d).withColumn("FlightDate", fn.date_from_parts())


@query("scan_csv", ORDERS_SQL)
def scan_csv(spark, d):
    path = scratch_path(spark, "csv")
    sinks.write_csv(orders(spark, d), path)
    return readers.read_csv(spark, path, ORDERS)


@query("scan_csv_recursive", ORDERS_SQL)
def scan_csv_recursive(spark, d):
    path = scratch_path(spark, "tree")
    tree = orders(spark, d).withColumn("folder", F.col("o_orderstatus"))
    tree.write.partitionBy("folder").option("header", True).csv(path)
    return readers.read_csv(spark, path, ORDERS, recursive=True)


@query("month_range", sql("""
    SELECT CAST(m AS DATE) AS month_start, CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month,
           'T_ONTIME_REPORTING-' || strftime(m, '%m_%y') || '.csv' AS file_name
    FROM (SELECT unnest(generate_series(date_trunc('month', (SELECT min(d) FROM lines)),
                                        date_trunc('month', (SELECT max(d) FROM lines)), INTERVAL 1 MONTH)) AS m)""", "lines"))
def month_range(spark, d):
    return readers.months_of(dated(spark, d), "FlightDate")


@query("missing_months", sql("""
    SELECT CAST(m AS DATE) AS month_start
    FROM (SELECT unnest(generate_series(date_trunc('month', (SELECT min(d) FROM lines)),
                                        date_trunc('month', (SELECT max(d) FROM lines)), INTERVAL 1 MONTH)) AS m)
    WHERE m NOT IN (SELECT date_trunc('month', FlightDate) FROM dated WHERE CANCELLED = 1 AND DIVERTED = 1)""", "lines", "dated"))
def missing_months(spark, d):
    rows = dated(spark, d)
    affected = rows.where("CANCELLED = 1 AND DIVERTED = 1")
    calendar = readers.months_of(rows, "FlightDate").select("month_start")
    return readers.missing_from(calendar, affected, "month_start", fn.month_floor("FlightDate"))


@query("scan_parquet", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45")
def scan_parquet(spark, d):
    return fx.table(spark, d, "lineitem").where("l_quantity > 45").select("l_orderkey", "l_linenumber", "l_quantity")


@query("snapshot_slice", sql("""
    SELECT snapshot_date, flight_id, IS_DELAYED, proba_0 FROM preds WHERE snapshot_date = DATE '2025-01-20'""", "preds"))
def snapshot_slice(spark, d):
    rows = readers.snapshot_slice(fx.predictions(spark, d), "2025-01-20")
    return rows.select("snapshot_date", "flight_id", "IS_DELAYED", "proba_0")


@query("snapshot_backfill", sql("""
    SELECT ORIGIN, DEST, OP_CARRIER_FL_NUM, FlightDate AS snapshot_date FROM dated""", "dated"))
def snapshot_backfill(spark, d):
    return readers.snapshot_backfill(dated(spark, d)).select("ORIGIN", "DEST", "OP_CARRIER_FL_NUM", "snapshot_date")


@query("snapshot_backfill_daily", sql("""
    SELECT ORIGIN, DEST, OP_CARRIER_FL_NUM, DATE '1998-06-15' AS snapshot_date FROM dated
    WHERE FlightDate = DATE '1998-06-15'""", "dated"))
def snapshot_backfill_daily(spark, d):
    rows = readers.snapshot_slice(dated(spark, d), "1998-06-15", "FlightDate")
    return readers.snapshot_backfill(rows, "1998-06-15").select("ORIGIN", "DEST", "OP_CARRIER_FL_NUM", "snapshot_date")


@query("date_range_scan", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1997-12-31'""")
def date_range_scan(spark, d):
    return readers.date_range_scan(orders(spark, d), "1996-03-01", "1997-12-31", "o_orderdate", ["o_orderkey", "o_totalprice"])


@query("load_any", """
    SELECT 'parquet' AS origin, o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders
    UNION ALL SELECT 'text', o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
    UNION ALL SELECT 'text', o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
    UNION ALL SELECT 'mixed', o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
    UNION ALL SELECT 'mixed', o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders""")
def load_any(spark, d):
    """Tables, text and a mixed folder; the text files list their columns in two orders."""
    base = scratch_path(spark, "any")
    rows = orders(spark, d).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    named = lambda origin: rows.select(F.lit(origin).alias("origin"), "*")
    schema = named("x").schema
    turned = lambda df: df.select(*reversed(df.columns))
    named("parquet").drop("o_orderpriority").write.parquet(f"{base}/a.parquet")
    sinks.write_csv(named("text"), f"{base}/b.csv")
    turned(named("text")).write.option("header", True).option("compression", "gzip").csv(f"{base}/c.csv.gz")
    named("mixed").write.parquet(f"{base}/mixed/p")
    sinks.write_csv(turned(named("mixed")), f"{base}/mixed/t")
    paths = [f"{base}/{name}" for name in ("a.parquet", "b.csv", "c.csv.gz", "mixed")]
    return readers.load_any(spark, *paths, schema=schema)


STITCH_DATE, STITCH_CUT = "2001-06-01", "2001-01-01"


@query("stitch_history_daily", sql(f"""
    SELECT FlightDate AS snapshot_date, FlightDate, ORIGIN, DEST, OP_CARRIER_FL_NUM, CRS_DEP_TIME FROM dated
    WHERE FlightDate BETWEEN DATE '{STITCH_DATE}' - INTERVAL 24 MONTH AND DATE '{STITCH_DATE}' - INTERVAL 1 DAY""", "dated"))
def stitch_history_daily(spark, d):
    rows = readers.snapshot_backfill(dated(spark, d)).select(
        "snapshot_date", "FlightDate", "ORIGIN", "DEST", "OP_CARRIER_FL_NUM", "CRS_DEP_TIME")
    history = rows.where(F.col("snapshot_date") < STITCH_CUT)
    daily = rows.where(F.col("snapshot_date") >= STITCH_CUT).drop("FlightDate")
    return readers.stitch(history, daily, STITCH_DATE, 24)


@query("missing_days", sql("""
    SELECT CAST(x AS DATE) AS day
    FROM (SELECT unnest(generate_series((SELECT CAST(min(d) AS TIMESTAMP) FROM lines), (SELECT CAST(max(d) AS TIMESTAMP) FROM lines),
                                        INTERVAL 1 DAY)) AS x)
    WHERE CAST(x AS DATE) NOT IN (SELECT FlightDate FROM dated WHERE CANCELLED = 1)""", "lines", "dated"))
def missing_days(spark, d):
    rows = dated(spark, d)
    return readers.missing_from(readers.days_of(rows, "FlightDate"), rows.where("CANCELLED = 1"), "day", "FlightDate")


@query("window_scan", sql("""
    SELECT Customer_ID, label_snapshot_date, fe_2 FROM fx_features
    WHERE label_snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1998-06-30'""", "fx_features"))
def window_scan(spark, d):
    return readers.date_range_scan(fx.features(spark, d), "1997-01-01", "1998-06-30", "label_snapshot_date",
                                   ["Customer_ID", "label_snapshot_date", "fe_2"])


@query("sink_partitioned", sql("""
    SELECT year_month, FlightDate, ORIGIN, DEST, OP_CARRIER_FL_NUM, sort_time,
           CASE WHEN year_month = '1998-06' THEN 2 ELSE 1 END AS version FROM bronze""", "bronze"))
def sink_partitioned(spark, d):
    """Write all months, replace one of them, and read the table back."""
    path = scratch_path(spark, "bronze")
    rows = jobs.bronze_flights(fx.flights(spark, d)).select(
        "year_month", "FlightDate", "ORIGIN", "DEST", "OP_CARRIER_FL_NUM", "sort_time", "OP_UNIQUE_CARRIER")
    order = ["FlightDate", "sort_time", "OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM"]
    sinks.write_partitioned(rows.withColumn("version", F.lit(1)), path, "year_month", order)
    sinks.write_partitioned(rows.where("year_month = '1998-06'").withColumn("version", F.lit(2)), path, "year_month", order)
    return spark.read.parquet(path).drop("OP_UNIQUE_CARRIER")


@query("sink_append", sql("""
    SELECT snapshot_date, flight_id, IS_DELAYED FROM preds""", "preds"))
def sink_append(spark, d):
    """Write some days and half of another, append everything twice: late rows and new days are added, once."""
    path = scratch_path(spark, "appended")
    rows = fx.predictions(spark, d).select("snapshot_date", "flight_id", "IS_DELAYED")
    early = "snapshot_date < date '2025-01-19' or snapshot_date = date '2025-01-19' and IS_DELAYED = 0"
    sinks.write_partitioned(rows.where(early), path, "snapshot_date", ["flight_id"])
    for _ in range(2):
        sinks.append_new_rows(rows, path)
    return spark.read.parquet(path)


@query("sink_cutoff_split", sql("""
    SELECT CASE WHEN d < DATE '2001-06-01' THEN 'history' ELSE strftime(d, '%Y-%m-%d') END AS slice, NAME, d AS extracted_date, TMP
    FROM timed WHERE d <= DATE '2001-07-15'""", "timed"))
def sink_cutoff_split(spark, d):
    from delayworks.operators import weather
    path = scratch_path(spark, "weather")
    rows = weather.bronze_weather(fx.weather(spark, d), "2001-07-15")
    sinks.write_cutoff_split(rows, path, "extracted_date", "2001-06-01", ["NAME", "DATE"])
    return spark.read.parquet(path).select("slice", "NAME", "extracted_date", "TMP")


@query("ingest_reference", """
    SELECT c_custkey, c_name, c_acctbal, true AS has_ts, true AS has_date, 'customers' AS table_name FROM customer""")
def ingest_reference(spark, d):
    base = scratch_path(spark, "ingest")
    sinks.write_csv(fx.table(spark, d, "customer"), f"{base}/customers.csv")
    jobs.run_ingest_reference(spark, f"{base}/customers.csv", f"{base}/bronze", CUSTOMER)
    rows = spark.read.parquet(f"{base}/bronze/customers")
    folder = F.element_at(F.split("_source_file", "/"), -2)
    return rows.select("c_custkey", "c_name", "c_acctbal", F.col("_ingest_ts").isNotNull().alias("has_ts"),
                       F.col("_ingest_date").isNotNull().alias("has_date"),
                       F.regexp_replace(folder, r"\.csv$", "").alias("table_name"))


@query("sink_predictions", sql("""
    SELECT copy, snapshot_date, flight_id, proba_0, IS_DELAYED FROM preds, (VALUES ('parquet'), ('csv')) c(copy)""", "preds"))
def sink_predictions(spark, d):
    base = scratch_path(spark, "preds")
    rows = fx.predictions(spark, d).select("snapshot_date", "flight_id", "proba_0", "IS_DELAYED")
    sinks.write_predictions(rows, f"{base}/table", f"{base}/copy.csv")
    table = spark.read.parquet(f"{base}/table").select(F.lit("parquet").alias("copy"), *rows.columns)
    text = readers.read_csv(spark, f"{base}/copy.csv", rows.schema).select(F.lit("csv").alias("copy"), *rows.columns)
    return table.unionByName(text)


@query("sink_metrics", sql("""
    SELECT 'class_' || IS_DELAYED AS metric, CAST(count(*) AS DOUBLE) AS value, snapshot_date AS period
    FROM preds WHERE snapshot_date IN (DATE '2025-01-20', DATE '2025-01-21') GROUP BY IS_DELAYED, snapshot_date""", "preds"))
def sink_metrics(spark, d):
    """Two days written one after the other, the second twice: both stay."""
    path = scratch_path(spark, "metrics")
    for day in ("2025-01-20", "2025-01-21", "2025-01-21"):
        today = readers.snapshot_slice(fx.predictions(spark, d), day)
        counts = profile.class_distribution(today, "IS_DELAYED")
        rows = counts.select(F.concat(F.lit("class_"), "IS_DELAYED").alias("metric"),
                             F.col("n_rows").cast("double").alias("value"), F.lit(day).cast("date").alias("period"))
        sinks.write_metrics(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("read_months", """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, 'T_ONTIME_REPORTING-' || strftime(CAST(o_orderdate AS DATE), '%m_%y') || '.csv' AS source_file
    FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-06-30' AND month(CAST(o_orderdate AS DATE)) <> 3""")
def read_months(spark, d):
    """Monthly files with two orders of columns, one month missing, one outside the range."""
    base = scratch_path(spark, "months")
    rows = orders(spark, d).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    fs = spark._jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    for month in (1, 2, 4, 5, 6, 7):
        part = rows.where((F.year("o_orderdate") == 1996) & (F.month("o_orderdate") == month)).drop("o_orderdate")
        part = part.select(*(part.columns if month % 2 else reversed(part.columns)))
        sinks.write_csv(part.coalesce(1), f"{base}/parts/{month}")
        made = fs.globStatus(to_path(f"{base}/parts/{month}/part-*"))[0].getPath()
        fs.mkdirs(to_path(f"{base}/files"))
        fs.rename(made, to_path(f"{base}/files/{readers.month_file(1996, month)}"))
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
    return readers.read_months(spark, f"{base}/files", (1996, 1), (1996, 6), types)


@query("load_report", sql("""
    SELECT count(*) AS rows_read, count(*) FILTER (WHERE FlightDate = DATE '1998-06-15') AS rows_on_day,
           count(*) FILTER (WHERE FlightDate = DATE '1998-06-15' AND (ORIGIN IN ('JFK', 'LGA', 'EWR') OR DEST IN ('JFK', 'LGA', 'EWR')))
           AS rows_kept FROM dated""", "dated"))
def load_report(spark, d):
    return cleaning.load_report(fx.flights(spark, d), "1998-06-15")
