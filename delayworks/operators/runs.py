"""Queries over the table of tracked runs, labels by month, retraining."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.functions.flights import month_floor
from delayworks.operators.cleaning import keep_first
from delayworks.operators.ranking import SLICE_ROWS, carried_last
from delayworks.sources.schemas import try_resolve

# Names a score column may have, least ages for retraining.
SCORE_NAMES = ("default_proba", "score", "prob", "proba", "predicted_default_risk")
RETRAIN_MONTHS, RETRAIN_DAYS = 2, 60


def latest_label(labels: DataFrame, load_order: str) -> DataFrame:
    """Last loaded label per customer and day; equal load order goes to the larger label."""
    order = [F.col(load_order).desc(), F.col("label").desc_nulls_last()]
    return keep_first(labels, ["Customer_ID", "snapshot_date"], order)


def monthly_labels(labels: DataFrame, month, load_order: str) -> DataFrame:
    """Labels of one month: last one per key, a missing label as 0."""
    kept = labels.where(month_floor("snapshot_date") == F.trunc(F.lit(month).cast("date"), "MM"))
    last = latest_label(kept, load_order)
    return last.select("Customer_ID", "snapshot_date",
                       F.coalesce(F.col("label").try_cast("int"), F.lit(0)).alias("label"))


def standard_scores(df: DataFrame) -> DataFrame:
    """Scores under standard names: customer, snapshot day, probability, run."""
    score = next((c for c in SCORE_NAMES if c in df.columns), None)
    day = "snapshot_date" if "snapshot_date" in df.columns else try_resolve(df, "label_snapshot_date")
    if score is None or day is None:
        raise KeyError("no score or date column")
    extra = ["run_id"] if "run_id" in df.columns else []
    return df.select("Customer_ID", F.to_date(day).alias("snapshot_date"), F.col(score).alias("default_proba"), *extra)


def latest_run_for_month(runs: DataFrame, scores: DataFrame, month) -> DataFrame:
    """Scores of a month from the newest finished run that has any for it."""
    rows = standard_scores(scores).where(month_floor("snapshot_date") == F.trunc(F.lit(month).cast("date"), "MM"))
    scored = rows.select("run_id").distinct()
    finished = runs.where("status = 'FINISHED'").select("run_id", "start_time")
    newest = finished.join(scored, "run_id", "left_semi").agg(
        F.max_by("run_id", F.struct("start_time", "run_id"))).scalar()
    return rows.where(F.col("run_id") == newest)


def best_run(runs: DataFrame, metric: str, train_date=None, min_test_auc: float | None = None) -> DataFrame:
    """Finished run with the best metric per training date; runs without a number as metric are left out.

    ``promote`` tells whether the run passes the least test AUC.
    """
    value = F.col(metric).try_cast("double")
    usable = runs.where("status = 'FINISHED'").withColumn("metric_value", value).where(
        F.col("metric_value").isNotNull() & ~F.isnan("metric_value"))
    if train_date is not None:
        usable = usable.where(F.col("train_date") == F.lit(train_date).cast("date"))
    best = keep_first(usable, ["train_date"], [F.desc("metric_value"), F.asc("run_id")])
    guard = F.lit(True) if min_test_auc is None else F.coalesce(F.col("auc_test") >= min_test_auc, F.lit(False))
    return best.withColumn("promote", guard)


def retrain_decision(days: DataFrame, production: DataFrame, rule: str = "months", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """'retrain' or 'infer' for each day, by the age of the model in production that day.

    ``production`` has one row per promotion. A day without a model retrains. Rule
    'months' counts calendar months, rule 'days' counts days.
    """
    # as-of join: promotions and days in one order, each day takes the last promotion before or on it
    promoted = production.select(F.col("train_date").alias("_at"), F.lit(0).alias("_asked"), F.col("train_date").alias("_promoted")).distinct()
    asked = days.select(F.col("day").alias("_at"), F.lit(1).alias("_asked"), F.lit(None).cast("date").alias("_promoted"),
                        F.struct(*days.columns).alias("_row"))
    both = promoted.withColumn("_row", F.lit(None).cast(asked.schema["_row"].dataType)).unionByName(asked)
    carried = carried_last(both, ["_at", "_asked"], "_promoted", "production_date", slice_rows)
    rows = carried.where("_row is not null").select("_row.*", "production_date")
    months = (F.year("day") - F.year("production_date")) * 12 + F.month("day") - F.month("production_date")
    age = F.datediff("day", "production_date")
    due = months >= RETRAIN_MONTHS if rule == "months" else age >= RETRAIN_DAYS
    keep = F.coalesce(~due, F.lit(False))
    return rows.withColumn("decision", F.when(keep, "infer").otherwise("retrain"))
