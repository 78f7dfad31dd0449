"""Loan snapshots, days past due and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.functions.flights import flag
from delayworks.sources import schemas


def loan_types(df: DataFrame) -> DataFrame:
    """Typed loan columns and month on book."""
    typed = schemas.apply_types(df, schemas.LOAN_TYPES)
    return typed.withColumn("mob", F.col("installment_num").cast("int"))


def installments_missed(df: DataFrame) -> DataFrame:
    """Installments overdue, rounded up; afterwards every numeric null of the table becomes 0."""
    missed = F.ceil(F.try_divide(F.col("overdue_amt").cast("double"), F.col("due_amt").cast("double")))
    return df.withColumn("installments_missed", missed.cast("int")).fillna(0)


def first_missed_date(df: DataFrame) -> DataFrame:
    missed = F.col("installments_missed")
    return df.withColumn("first_missed_date", F.when(missed > 0, F.add_months("snapshot_date", -missed)))


def days_past_due(df: DataFrame) -> DataFrame:
    late = F.datediff("snapshot_date", "first_missed_date")
    return df.withColumn("dpd", F.when(F.col("overdue_amt") > 0, late).otherwise(0).cast("int"))


def loan_silver(df: DataFrame) -> DataFrame:
    return (
        df.transform(loan_types).transform(installments_missed)
        .transform(first_missed_date).transform(days_past_due)
    )


def closed_cohort(silver: DataFrame, started_before, dpd: int = 30) -> DataFrame:
    """Loans started before a day, with the flag for being at least ``dpd`` days past due."""
    kept = silver.where(F.col("loan_start_date") < F.lit(started_before).cast("date"))
    return kept.withColumn("dpd_flag", flag(F.col("dpd") >= dpd))


def loan_label(silver: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """Label of a loan at one month on book: at least ``dpd`` days past due (an inferred rule)."""
    return silver.where(F.col("mob") == mob).select(
        "loan_id", "Customer_ID", "snapshot_date", flag(F.col("dpd") >= dpd).alias("label"))


def bad_rate_curve(cohort: DataFrame) -> DataFrame:
    """Share of flagged loans by month on book."""
    return cohort.groupBy("mob").agg(F.avg("dpd_flag").alias("bad_rate"), F.count("*").alias("loans")).orderBy("mob")
