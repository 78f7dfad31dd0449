"""Model quality as distributed queries.

Confusion counts give the threshold metrics; the ranking metrics work on counts per
distinct score and their running totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayworks.operators.ranking import running_totals

CLASSES = (0, 1, 2)
PROBABILITIES = ("proba_0", "proba_1", "proba_2")


def argmax_class(probabilities=PROBABILITIES) -> Column:
    """Position of the largest probability, the first one among equals."""
    array = F.array(*[F.col(c) for c in probabilities])
    return (F.array_position(array, F.array_max(array)) - 1).cast("int")


def max_probability(probabilities=PROBABILITIES) -> Column:
    return F.greatest(*[F.col(c) for c in probabilities])


def one_vs_rest(df: DataFrame, label: str, probabilities=PROBABILITIES) -> DataFrame:
    """(class, score, positives, negatives) counts per class and distinct score."""
    rows = F.array(*[F.struct(F.lit(k).alias("class"), F.col(p).alias("score"),
                              F.when(F.col(label) == k, 1).otherwise(0).alias("hit"))
                     for k, p in enumerate(probabilities)])
    long = df.select(F.inline(rows))
    return long.groupBy("class", "score").agg(
        F.sum(F.col("hit").cast("bigint")).alias("pos"),
        F.sum((1 - F.col("hit")).cast("bigint")).alias("neg"))


def binary_scores(df: DataFrame, label: str, score: str) -> DataFrame:
    """The same counts for one positive class."""
    hit = F.when(F.col(label) == 1, 1).otherwise(0)
    return df.select(F.lit(1).alias("class"), F.col(score).alias("score"), hit.alias("hit")) \
        .groupBy("class", "score").agg(F.sum(F.col("hit").cast("bigint")).alias("pos"),
                                       F.sum((1 - F.col("hit")).cast("bigint")).alias("neg"))


def ranking_by_class(counts: DataFrame) -> DataFrame:
    """ROC AUC and average precision per class, null for a class without both outcomes.

    AUC counts, for every score, the negatives below it and half of those that tie.
    Average precision sums precision over the gain in recall, one step per distinct score.
    """
    placed = running_totals(counts, ["class"], ["score"], ["pos", "neg"])
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    all_pos, all_neg = F.col("total_pos").cast("double"), F.col("total_neg").cast("double")
    pairs = F.sum(pos * (F.col("before_neg") + neg / 2))
    above_pos, above_neg = all_pos - F.col("before_pos"), all_neg - F.col("before_neg")
    steps = F.sum(pos * above_pos / (above_pos + above_neg))
    out = placed.groupBy("class").agg(
        F.max("total_pos").alias("positives"), F.max("total_neg").alias("negatives"),
        pairs.alias("pairs"), steps.alias("steps"))
    p, n = F.col("positives"), F.col("negatives")
    return out.select("class", "positives", "negatives",
                      F.when((p > 0) & (n > 0), F.col("pairs") / (p.cast("double") * n)).alias("auc"),
                      F.when(p > 0, F.col("steps") / p).alias("average_precision"))


def macro_ranking(by_class: DataFrame, fixed_classes: bool = False) -> DataFrame:
    """Mean AUC and average precision; over the fixed classes, or over those that occur."""
    ap = F.coalesce(F.col("average_precision"), F.lit(0.0)) if fixed_classes else F.col("average_precision")
    return by_class.agg(F.avg("auc").alias("roc_auc_macro_ovr"), F.avg(ap).alias("pr_auc_macro"))


def confusion_counts(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(label).cast("int").alias("actual"), F.col(predicted).cast("int").alias("predicted")) \
        .agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, label: str, predicted: str, classes=CLASSES) -> DataFrame:
    """Every pair of actual and predicted class with its number of rows, zero cells included."""
    cells = [(a, p) for a in classes for p in classes]
    wide = df.agg(*[F.count_if((F.col(label) == a) & (F.col(predicted) == p)).alias(f"c{a}_{p}") for a, p in cells])
    rows = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{a}_{p}").alias("n"))
                     for a, p in cells])
    return wide.select(F.inline(rows))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Accuracy and micro, macro and weighted precision, recall and F1, as one row.

    Averages run over the classes that occur as actual or predicted; a division by
    zero counts as 0.
    """
    cells = confusion_counts(df, label, predicted)
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("called")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("called")))
    right = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    # The side rows carry each cell twice, so a hit is counted on the actual side only.
    per = cells.select(F.col("actual"), right.alias("right"), F.inline(sides)).groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("called").alias("called"),
        F.sum(F.when(F.col("support") > 0, F.col("right")).otherwise(0)).alias("tp"))
    precision, recall = _ratio(F.col("tp"), F.col("called")), _ratio(F.col("tp"), F.col("support"))
    f1 = _ratio(2 * F.col("tp"), F.col("called") + F.col("support"))
    scored = per.withColumns({"precision": precision, "recall": recall, "f1": f1})
    mean = lambda c: F.avg(c)
    weighted = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    accuracy = F.sum("tp").cast("double") / F.sum("support")
    names = ("precision", "recall", "f1")
    return scored.agg(
        accuracy.alias("accuracy"),
        *[accuracy.alias(f"{c}_micro") for c in names],
        *[mean(c).alias(f"{c}_macro") for c in names],
        *[weighted(c).alias(f"{c}_weighted") for c in names])


def quadratic_kappa(df: DataFrame, label: str, predicted: str, classes=CLASSES) -> DataFrame:
    """Cohen's kappa with squared distance weights: 1 - observed over expected disagreement.

    The expected disagreement follows from the first two moments of both marginals, so
    one aggregate over the rows is enough.
    """
    a, p = F.col(label).cast("double"), F.col(predicted).cast("double")
    m = df.agg(F.avg((a - p) * (a - p)).alias("seen"), F.avg(a).alias("a1"), F.avg(p).alias("p1"),
               F.avg(a * a).alias("a2"), F.avg(p * p).alias("p2"))
    expected = F.col("a2") + F.col("p2") - 2 * F.col("a1") * F.col("p1")
    return m.select((1 - F.try_divide(F.col("seen"), expected)).alias("qwk"))


def binary_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """AUC and threshold metrics of a binary score; a missing score counts as 0."""
    s = F.coalesce(F.col(score).try_cast("double"), F.lit(0.0))
    rows = df.select(F.col(label).cast("int").alias("y"), s.alias("s"))
    yes, called = F.col("y") == 1, F.col("s") >= threshold
    cells = rows.agg(F.count_if(yes & called).alias("tp"), F.count_if(~yes & ~called).alias("tn"),
                     F.count_if(~yes & called).alias("fp"), F.count_if(yes & ~called).alias("fn"))
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    f1_yes, f1_no = _ratio(2 * tp, 2 * tp + fp + fn), _ratio(2 * tn, 2 * tn + fp + fn)
    # A class that neither occurs nor is called has no part in the averages.
    has_yes, has_no = F.when(tp + fp + fn > 0, 1).otherwise(0), F.when(tn + fp + fn > 0, 1).otherwise(0)
    total = tp + tn + fp + fn
    auc = ranking_by_class(binary_scores(rows, "y", "s")).select("auc").scalar()
    return cells.select(
        auc.alias("auc_roc"), _ratio(tp + tn, total).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"),
        _ratio(f1_yes * has_yes + f1_no * has_no, has_yes + has_no).alias("f1_macro"),
        _ratio(f1_yes * (tp + fn) + f1_no * (tn + fp), total).alias("f1_weighted"),
        "tp", "tn", "fp", "fn")


def gini(auc: Column) -> Column:
    return 2 * auc - 1


def score_summary(df: DataFrame, score: Column | str, std=F.stddev_samp) -> DataFrame:
    """Size, extremes, mean and deviation of a score; unreadable scores are left out."""
    s = (F.col(score) if isinstance(score, str) else score).try_cast("double")
    return df.select(s.alias("s")).agg(
        F.count("s").alias("sample_size"), F.min("s").alias("score_min"), F.max("s").alias("score_max"),
        F.avg("s").alias("score_mean"), std("s").alias("score_std"))


def max_proba_summary(df: DataFrame, probabilities=PROBABILITIES) -> DataFrame:
    """The same for the largest class probability, with the population deviation."""
    out = score_summary(df, max_probability(probabilities), F.stddev_pop)
    return out.withColumnsRenamed({
        "score_min": "prob_max_min", "score_max": "prob_max_max",
        "score_mean": "prob_max_mean", "score_std": "prob_max_std"})


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for reports."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def melt(df: DataFrame, prefix: str = "") -> DataFrame:
    """One-row metrics frame as (metric, value) rows."""
    rows = F.array(*[F.struct(F.lit(prefix + c).alias("metric"), F.col(c).cast("double").alias("value"))
                     for c in df.columns])
    return df.select(F.inline(rows))
