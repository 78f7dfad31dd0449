"""Profiles of a table: counts, distributions, coverage, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delayworks.operators.ranking import long_values, quantiles

SLOT_COLUMNS = ("dep_3hour_col", "arr_3hour_col")
FLAG_COLUMNS = ("is_rare", "is_abnormal_num", "is_peak_day", "is_extra_candidate")


def table_profile(df: DataFrame, date_col: str) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows and percentage per value of a column with few values."""
    counts = df.groupBy(target).agg(F.count("*").alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(0)))  # one row per value
    return counts.withColumn("pct", F.round(100.0 * F.col("n_rows") / total, 6))


def distinct_counts(df: DataFrame, columns) -> DataFrame:
    """Distinct values of each column, a null counted as a value of its own.

    The rows are first reduced to the distinct combinations, so that only those are counted once per column.
    """
    df = df.select(*columns).distinct()
    counts = [(F.count_distinct(F.col(c)) + F.max(F.when(F.col(c).isNull(), 1).otherwise(0))).alias(c) for c in columns]
    return _unpivot(df.agg(*counts), columns, "n_distinct", "bigint")


def flag_rates(df: DataFrame, columns=FLAG_COLUMNS) -> DataFrame:
    """Count and percentage of 1 per flag column, in one pass."""
    sums = df.agg(F.count("*").alias("_n"), *[F.sum(F.col(c).cast("bigint")).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_set"),
                              F.round(100.0 * F.col(c) / F.col("_n"), 6).alias("pct")) for c in columns])
    return sums.select(F.inline(rows))


def null_report(df: DataFrame, columns=None, top: int | None = None) -> DataFrame:
    """Nulls and coverage per column from one pass; with ``top``, the columns with most nulls only."""
    columns = list(columns or df.columns)
    sums = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_null"),
        F.round(100.0 * (F.col("_n") - F.col(f"`{c}`")) / F.col("_n"), 6).alias("coverage_pct"),
    ) for c in columns])
    report = sums.select(F.inline(rows))
    return report.orderBy(F.desc("n_null"), "column").limit(top) if top else report


def counts_by(df: DataFrame, date_col: str, unit: str) -> DataFrame:
    """Rows per day ('DD') or month ('MM')."""
    return df.groupBy(F.trunc(F.col(date_col).cast("date"), "MM").alias("period") if unit == "MM"
                      else F.col(date_col).cast("date").alias("period")).agg(F.count("*").alias("n_rows"))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """Most frequent values, nulls left out; equal counts in order of the value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), column).limit(n)


def day_category_pivot(df: DataFrame, date_col: str, column: str, n: int) -> DataFrame:
    """Rows per day and category for the ``n`` most frequent categories, 0 where there are none."""
    names = sorted(row[column] for row in top_values(df, column, n).collect())  # n values
    counts = df.groupBy(F.col(date_col).cast("date").alias("day")).pivot(column, names).agg(F.count(F.lit(1)))
    return counts.fillna(0).withColumnsRenamed({v: f"n_{v}" for v in names})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def numeric_summary(df: DataFrame, columns=None) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles per numeric column.

    All but the quartiles come from one wide aggregate; the quartiles from counted values.
    """
    columns = list(columns or numeric_columns(df))
    value = {c: F.col(f"`{c}`").cast("double") for c in columns}
    wide = df.agg(*[F.struct(
        F.lit(c).alias("column"), F.count(v).alias("n"), F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev_samp(v), 6).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max")).alias(f"_{i}") for i, (c, v) in enumerate(value.items())])
    basics = wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))]))).where("n > 0")
    q = quantiles(long_values(df, columns), [0.25, 0.5, 0.75], ["column"])
    at = lambda p: F.round(F.max(F.when(F.col("prob") == p, F.col("quantile"))), 6)
    quartiles = q.groupBy("column").agg(at(0.25).alias("q25"), at(0.5).alias("q50"), at(0.75).alias("q75"))
    return basics.join(quartiles, "column")


def correlation_matrix(df: DataFrame, columns=None) -> DataFrame:
    """Pearson correlation of every pair of columns (all numeric ones by default), each over the rows that have both."""
    columns = list(columns or numeric_columns(df))
    half = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_{i}")
                    for i, (a, b) in enumerate(half)])
    cell = {pair: i for i, pair in enumerate(half)} | {(b, a): i for i, (a, b) in enumerate(half)}
    rows = F.array(*[F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                              F.round(F.col(f"_{cell[a, b]}"), 6).alias("correlation")) for a in columns for b in columns])
    return wide.select(F.inline(rows))


def schema_report(df: DataFrame) -> DataFrame:
    """Position, type and number of values per column, with the group its name belongs to."""
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f.name) for f in df.schema])
    kind = lambda c: "weather" if c.startswith("weather_") else "key" if c == "snapshot_date" else "flight"
    rows = F.array(*[F.struct(
        F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
        F.lit(f.dataType.simpleString()).alias("type"), F.lit(kind(f.name)).alias("column_group"),
        F.col(f"`{f.name}`").alias("n_values")) for i, f in enumerate(df.schema)])
    return counts.select(F.inline(rows))


def sample_values(df: DataFrame, columns, n: int) -> DataFrame:
    """First ``n`` distinct values in order."""
    return df.select(*columns).distinct().orderBy(*columns).limit(n)


def head_rows(df: DataFrame, order, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def distinct_dates(df: DataFrame, date_col: str) -> DataFrame:
    return df.select(date_col).where(F.col(date_col).isNotNull()).distinct()


def _unpivot(one_row: DataFrame, columns, value: str, kind: str) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias(value)) for c in columns])
    return one_row.select(F.inline(rows))
