"""Table writers. Each is one distributed write; none loops over days on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from delayworks.sources.staging import stage


def write_partitioned(df: DataFrame, path: str, by: str, order: list[str] | None = None, mode: str = "overwrite") -> None:
    """Table laid out by a column, replacing only the partitions that the frame holds.

    Rows of one partition value are brought together, so that it gets few files; the
    rebalance splits a value with a large share of the rows over several tasks and files,
    and computes the frame once (a range partitioning would compute it twice).
    """
    order = [c for c in (order or []) if c != by]
    (
        df.hint("rebalance", F.col(by))
        .sortWithinPartitions(by, *order)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def append_new_rows(df: DataFrame, path: str, by: str = "snapshot_date", ignore: tuple[str, ...] = ()) -> None:
    """Append the rows that the table does not hold yet, late rows of a stored partition included.

    Rows are compared in all columns but the ignored ones, nulls and copies counted: a row that the table holds once and
    the frame twice is appended once. A rerun adds nothing. Only the partitions that the frame has rows for are read.
    """
    key = [c for c in df.columns if c not in ignore]
    stored = df.sparkSession.read.parquet(path)
    held = stored.select(*[F.col(f"`{c}`").cast(df.schema[c].dataType).alias(c) for c in key])
    held = held.join(df.select(by).distinct(), by, "left_semi").groupBy(*key).agg(F.count("*").alias("_held"))
    held = held.withColumnsRenamed({c: f"_held_{c}" for c in key})
    numbered = df.withColumn("_copy", F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0))))
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`_held_{c}`")) for c in key]
    new = numbered.join(held, same, "left").where(F.col("_copy") > F.coalesce("_held", F.lit(0))).select(*df.columns)
    write_partitioned(stage(new, "append"), path, by, mode="append")


def with_slice(df: DataFrame, date_col: str, cutoff) -> DataFrame:
    """Add ``slice``: 'history' before the cut-off, the day itself from the cut-off on."""
    day = F.col(date_col)
    label = F.when(day < F.lit(cutoff).cast("date"), F.lit("history")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    return df.where(day.isNotNull()).withColumn("slice", label)


def write_cutoff_split(df: DataFrame, path: str, date_col: str, cutoff, order: list[str] | None = None) -> None:
    """One table with a history slice and a slice per day from the cut-off on."""
    write_partitioned(with_slice(df, date_col, cutoff), path, "slice", [date_col, *(order or [])])


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def with_lineage(df: DataFrame) -> DataFrame:
    """Add ingest time, source file and ingest date to a raw reference table."""
    return df.select(
        "*",
        F.current_timestamp().alias("_ingest_ts"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.current_date().alias("_ingest_date"),
    )


def write_predictions(df: DataFrame, path: str, csv_path: str | None = None) -> None:
    """Predictions by snapshot day, and a CSV copy on request; they are computed once for both."""
    if csv_path:
        df = stage(df, "predictions")
    write_partitioned(df, path, "snapshot_date")
    if csv_path:
        write_csv(df, csv_path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Long-format metrics (metric, value, period, ...) as JSON lines by period; other periods stay."""
    metrics.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").json(path)
