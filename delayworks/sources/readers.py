"""Scans of text and Parquet tables."""

from __future__ import annotations

import re
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delayworks.functions.flights import tolerant_date
from delayworks.sources.schemas import try_resolve

# Fixed value: name of a monthly flight file.
MONTH_FILE = "T_ONTIME_REPORTING-{month:02d}_{year2:02d}.csv"
PARQUET_SUFFIXES = (".parquet", ".parq", ".pq")
CSV_SUFFIXES = (".csv", ".csv.gz")


def read_csv(spark: SparkSession, path, schema: T.StructType | dict[str, str], recursive: bool = False) -> DataFrame:
    """CSV with a header row and declared types; no inference pass over the data.

    ``schema`` is a full schema or a map from column name to type: with a map the column
    order comes from the header and a column outside it is text. A file whose header
    disagrees is an error, not a silent misreading.
    """
    files = spark.read.option("header", True).option("recursiveFileLookup", recursive)
    if isinstance(schema, dict):
        types = {name.upper(): kind for name, kind in schema.items()}
        header = files.csv(path).columns  # reads one line
        schema = T.StructType([T.StructField(c, T.DataType.fromDDL(types.get(c.strip().upper(), "string"))) for c in header])
    return files.schema(schema).option("enforceSchema", False).csv(path)


def read_csv_files(spark: SparkSession, paths: list[str], schema: T.StructType | dict[str, str]) -> DataFrame:
    """CSV files whose headers may list columns in any order: columns are matched by name, case ignored.

    Files that share a header are read together. With a full schema the result has its columns, absent ones being null;
    with a map the columns of all files. ``paths`` are single files; one line of each is read to see its header.
    """
    full = schema if isinstance(schema, T.StructType) else None
    kinds = {f.name.upper(): f.dataType for f in full} if full else {n.upper(): T.DataType.fromDDL(k) for n, k in schema.items()}
    names = {f.name.upper(): f.name for f in full or ()}
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        by_header.setdefault(tuple(spark.read.option("header", True).csv(path).columns), []).append(path)
    frames = []
    for header, same in by_header.items():
        fields = [T.StructField(c, kinds.get(c.strip().upper(), T.StringType())) for c in header]
        df = read_csv(spark, same, T.StructType(fields)).withColumn("_source_file", F.col("_metadata.file_name"))
        df = df.withColumnsRenamed({c: names.get(c.strip().upper(), c) for c in header})
        if full:
            df = df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in full],
                           "_source_file")
        elif frames:  # the spelling of the first file
            spelling = {c.strip().upper(): c for c in frames[0].columns}
            df = df.withColumnsRenamed({c: spelling.get(c.strip().upper(), c) for c in df.columns})
        frames.append(df)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def month_file(year: int, month: int) -> str:
    return MONTH_FILE.format(month=month, year2=year % 100)


def month_range(spark: SparkSession, start: tuple[int, int], end: tuple[int, int]) -> DataFrame:
    """Every (year, month) from start to end, both included, with its file name."""
    first, last = date(*start, 1), date(*end, 1)
    months = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))).alias("month_start")
    )
    return months.transform(with_month_file)


def months_of(df: DataFrame, date_col: str) -> DataFrame:
    """Every month between the first and the last date of a table, gaps included."""
    span = df.agg(F.trunc(F.min(date_col), "MM").alias("a"), F.trunc(F.max(date_col), "MM").alias("b"))
    months = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month_start"))
    return months.transform(with_month_file)


def with_month_file(months: DataFrame) -> DataFrame:
    stamp = F.date_format("month_start", "MM_yy")
    return months.select(
        "month_start",
        F.year("month_start").alias("year"),
        F.month("month_start").alias("month"),
        F.concat(F.lit("T_ONTIME_REPORTING-"), stamp, F.lit(".csv")).alias("file_name"),
    )


def days_of(df: DataFrame, date_col: str) -> DataFrame:
    """Every day between the first and the last date of a table."""
    span = df.agg(F.min(date_col).alias("a"), F.max(date_col).alias("b"))
    return span.select(F.explode(F.sequence("a", "b")).alias("day"))


def missing_from(calendar: DataFrame, df: DataFrame, calendar_col: str, column) -> DataFrame:
    """Calendar entries that the table has no row for."""
    seen = df.select(F.col(column).alias(calendar_col) if isinstance(column, str) else column.alias(calendar_col))
    return calendar.join(seen.distinct(), calendar_col, "left_anti")


def read_months(spark: SparkSession, folder: str, start, end, schema) -> DataFrame:
    """The monthly files of a range that exist, with their file name; an error when there are none."""
    names = [row.file_name for row in month_range(spark, start, end).collect()]  # one row per month
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "{" + ",".join(names) + "}").load(folder)
    paths = sorted(r.path for r in listing.select("path").collect())
    if not paths:
        raise FileNotFoundError(f"no monthly file between {start} and {end} in {folder}")
    return read_csv_files(spark, paths, schema).withColumnRenamed("_source_file", "source_file")


def read_day(spark: SparkSession, folder: str, day: date, schema) -> DataFrame:
    """Rows source for one day: the file of its month; an error when that file is absent."""
    return read_months(spark, folder, (day.year, day.month), (day.year, day.month), schema)


def snapshot_slice(df: DataFrame, day, column: str = "snapshot_date") -> DataFrame:
    """One day of a table; prunes partitions when the table is laid out by that column."""
    return df.where(F.col(column) == F.lit(day).cast("date"))


def snapshot_backfill(df: DataFrame, day=None) -> DataFrame:
    """Add ``snapshot_date`` when missing: the given day, else each row's own flight date."""
    if "snapshot_date" in df.columns:
        return df
    return df.withColumn("snapshot_date", F.lit(day).cast("date") if day else F.col("FlightDate"))


def date_range_scan(df: DataFrame, start, end, column: str = "snapshot_date", columns=None) -> DataFrame:
    """Rows between two dates, both included; optionally only some columns."""
    kept = df.where(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return kept.select(*columns) if columns else kept


def load_any(spark: SparkSession, *paths: str, schema: T.StructType | None = None) -> DataFrame:
    """Load Parquet and CSV input together, matching columns by name.

    A path with a Parquet suffix is a Parquet table. Any other path is a file or a folder whose files of both kinds are
    read at any depth, by their suffixes, whatever the case; files without a known suffix take the kind that the path's
    own suffix names. CSV needs a schema: without one a CSV file is an error, never left out.
    """
    if not paths:
        raise FileNotFoundError("no input given")
    tables, text = [p for p in paths if p.lower().endswith(PARQUET_SUFFIXES)], []
    frames = [spark.read.parquet(*tables)] if tables else []
    loose: list[str] = []
    for path in (p for p in paths if p not in tables):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
        found = [r.path for r in files.collect()]  # the listing, one row per file
        as_text = path.lower().rstrip("/").endswith(CSV_SUFFIXES)
        text += [f for f in found if f.lower().endswith(CSV_SUFFIXES) or as_text and not f.lower().endswith(PARQUET_SUFFIXES)]
        loose += [f for f in found if f.lower().endswith(PARQUET_SUFFIXES)]
    if text and schema is None:
        raise ValueError("CSV input needs a schema")
    if loose:
        frames.append((spark.read.schema(schema) if schema else spark.read).parquet(*sorted(loose)))
    if text:
        frames.append(read_csv_files(spark, sorted(text), schema).drop("_source_file"))
    if not frames:
        raise FileNotFoundError(f"no Parquet or CSV file in {', '.join(paths)}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stitch(history: DataFrame, daily: DataFrame, train_date, months: int = 24) -> DataFrame:
    """History and daily slices in the window of ``months`` that ends the day before ``train_date``."""
    end = F.date_sub(F.lit(train_date).cast("date"), 1)
    start = F.add_months(F.lit(train_date).cast("date"), -months)
    if try_resolve(daily, "FlightDate") is None:
        daily = daily.withColumn("FlightDate", tolerant_date("snapshot_date"))
    both = history.unionByName(daily, allowMissingColumns=True)
    return both.where(F.col("snapshot_date").between(start, end))


def table_name_of(path: str) -> str:
    return re.sub(r"\.[^.]*$", "", path.rstrip("/").rsplit("/", 1)[-1])
