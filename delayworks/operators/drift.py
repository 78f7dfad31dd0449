"""Drift of scores against a reference period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayworks.operators.metrics import max_probability
from delayworks.operators.ranking import interpolate, running_totals
from delayworks.sources.staging import stage

# Bins, smoothing and least sizes.
BINS, SMOOTHING, LEAST_ROWS, LEAST_EDGES = 10, 1e-6, 50, 3
LEAST_KS_ROWS = 2


def score_counts(df: DataFrame, score: str | Column, is_reference: Column, is_current: Column) -> DataFrame:
    """(score, ref, cur): rows of both periods per distinct score."""
    score = F.col(score) if isinstance(score, str) else score
    rows = df.select(score.cast("double").alias("score"), is_reference.alias("r"), is_current.alias("c"))
    return rows.where("r or c").groupBy("score").agg(F.count_if("r").alias("ref"), F.count_if("c").alias("cur"))


def psi(counts: DataFrame, bins: int = BINS) -> DataFrame:
    """Population stability index over the quantile bins of the reference.

    Scores outside the reference range fall in no bin; the last bin is closed on the
    right. Null for fewer than 50 rows on a side or fewer than three distinct edges.
    """
    probs = [i / bins for i in range(bins + 1)]
    reference = counts.where("ref > 0").select(
        F.lit("ref").alias("side"), F.col("score").alias("value"), F.col("ref").alias("n"))
    placed = running_totals(reference, ["side"], ["value"], ["n"])
    edges = interpolate(placed, probs, ["side"]).agg(F.sort_array(F.collect_set("quantile"))).scalar()  # 11 values
    sizes = counts.agg(F.struct(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))).scalar()
    binned = counts.select("score", "ref", "cur", edges.alias("edges"))
    last = F.size("edges") - 1
    below = F.size(F.filter("edges", lambda e: e <= F.col("score")))
    place = F.when(F.col("score") == F.try_element_at("edges", F.lit(-1)), last).otherwise(below)
    inside = binned.select("ref", "cur", place.alias("bin"), last.alias("n_bins")).where("bin between 1 and n_bins")
    per_bin = inside.groupBy("bin", "n_bins").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    # A bin that neither side reaches still counts in the smoothed shares.
    all_bins = per_bin.agg(F.max("n_bins").alias("n_bins"), F.sum("ref").alias("all_ref"), F.sum("cur").alias("all_cur"),
                           F.collect_list(F.struct("ref", "cur")).alias("used"))  # at most ``bins`` entries
    share = lambda n, total: (n + SMOOTHING) / (total + SMOOTHING * F.col("n_bins"))
    def term(x):
        r, c = share(x["ref"], F.col("all_ref")), share(x["cur"], F.col("all_cur"))
        return (c - r) * F.ln(c / r)
    zero = F.struct(F.lit(0).cast("bigint").alias("ref"), F.lit(0).cast("bigint").alias("cur"))
    total = F.aggregate("used", F.lit(0.0), lambda acc, x: acc + term(x)) \
        + (F.col("n_bins") - F.size("used")) * term(zero)
    enough = (sizes["ref"] >= LEAST_ROWS) & (sizes["cur"] >= LEAST_ROWS) & (F.col("n_bins") >= LEAST_EDGES - 1)
    return all_bins.select(F.when(enough, total).alias("psi"))


def ks_statistic(counts: DataFrame) -> DataFrame:
    """Largest distance between the two empirical distributions; null for fewer than two rows a side."""
    placed = running_totals(counts.withColumn("one", F.lit(1)), ["one"], ["score"], ["ref", "cur"])
    share = lambda c: F.try_divide((F.col(f"before_{c}") + F.col(c)).cast("double"), F.col(f"total_{c}").cast("double"))
    out = placed.agg(F.max(F.abs(share("ref") - share("cur"))).alias("d"),
                     F.max("total_ref").alias("ref"), F.max("total_cur").alias("cur"))
    enough = (F.col("ref") >= LEAST_KS_ROWS) & (F.col("cur") >= LEAST_KS_ROWS)
    return out.select(F.when(enough, F.col("d")).alias("ks"))


def drift_report(predictions: DataFrame, day, days: int = 14, date_col: str = "snapshot_date") -> DataFrame:
    """PSI and KS of the largest class probability of a day against the days before it."""
    target = F.lit(day).cast("date")
    age = F.datediff(target, F.col(date_col))
    window = predictions.where(age.between(0, days))
    counts = score_counts(window, max_probability(), age.between(1, days), age == 0)
    counts = stage(counts, "scores")
    ks = ks_statistic(counts).scalar()
    return psi(counts).select(F.col("psi").alias("psi_max_proba"), ks.alias("ks_max_proba"))
