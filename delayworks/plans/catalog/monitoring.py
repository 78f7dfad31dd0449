"""Model quality, drift, runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from delayworks.operators import drift, models, runs
from delayworks.operators import metrics as mx
from delayworks.plans import fixtures as fx
from delayworks.plans import jobs
from delayworks.plans.catalog.io import dated
from delayworks.plans.oracle import sql
from delayworks.plans.registry import query
from delayworks.sources.staging import stage

LABEL = "IS_DELAYED"
DAY, MONTH = "2025-01-25", "1998-06-01"


def preds(spark, d):
    return fx.predictions(spark, d).withColumn("pred_class", mx.argmax_class())


def binary(spark, d):
    rows = fx.predictions(spark, d)
    late = F.when(F.col(LABEL) > 0, 1).otherwise(0).alias("label")
    return rows.select("snapshot_date", late, (1 - F.col("proba_0")).alias("default_proba"))


_BINARY = ", b AS (SELECT CASE WHEN IS_DELAYED > 0 THEN 1 ELSE 0 END AS y, 1 - proba_0 AS s FROM preds) "


@query("argmax_class", sql("SELECT flight_id, snapshot_date, proba_0, proba_1, proba_2, pred_class FROM preds", "preds"))
def argmax_class(spark, d):
    return preds(spark, d).select("flight_id", "snapshot_date", *mx.PROBABILITIES, "pred_class")


@query("score_threshold", sql("""
    SELECT Customer_ID, snapshot_date, default_proba, CASE WHEN default_proba >= 0.6 THEN 1 ELSE 0 END AS "default" FROM fx_scores""", "fx_scores"))
def score_threshold(spark, d):
    rows = runs.standard_scores(fx.scores(spark, d)).drop("run_id")
    return models.score_threshold(rows, "default_proba", 0.6)


def _auc(source: str) -> str:
    """Mann-Whitney form of AUC with average ranks, per class."""
    return f"""
    , ranked AS (SELECT class, hit, rank() OVER (PARTITION BY class ORDER BY score)
                   + (count(*) OVER (PARTITION BY class, score) - 1) / 2.0 AS r FROM {source})
    , aucs AS (SELECT class, sum(hit) AS p, count(*) - sum(hit) AS n,
                 (sum(CASE WHEN hit = 1 THEN r ELSE 0 END) - sum(hit) * (sum(hit) + 1) / 2.0) / (sum(hit) * (count(*) - sum(hit))) AS auc
               FROM ranked GROUP BY class)"""


def _ap(source: str) -> str:
    """Average precision from running counts over descending distinct scores, per class."""
    return f"""
    , steps AS (SELECT class, score, sum(hit) AS tp, count(*) AS c FROM {source} GROUP BY class, score)
    , curve AS (SELECT class, tp, sum(tp) OVER w AS ctp, sum(c) OVER w AS cc, sum(tp) OVER (PARTITION BY class) AS p
                FROM steps WINDOW w AS (PARTITION BY class ORDER BY score DESC))
    , aps AS (SELECT class, sum(CAST(tp AS DOUBLE) / p * ctp / cc) AS ap FROM curve GROUP BY class)"""


def _long(where: str = "true") -> str:
    return f""", long AS (
      SELECT 0 AS class, proba_0 AS score, CASE WHEN IS_DELAYED = 0 THEN 1 ELSE 0 END AS hit FROM preds WHERE {where}
      UNION ALL SELECT 1, proba_1, CASE WHEN IS_DELAYED = 1 THEN 1 ELSE 0 END FROM preds WHERE {where}
      UNION ALL SELECT 2, proba_2, CASE WHEN IS_DELAYED = 2 THEN 1 ELSE 0 END FROM preds WHERE {where})"""


@query("auc_by_class", sql(_long() + _auc("long") + _ap("long") + """
    SELECT aucs.class, CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives, round(CAST(auc AS DOUBLE), 6) AS auc,
           round(ap, 6) AS average_precision FROM aucs JOIN aps USING (class)""", "preds"))
def auc_by_class(spark, d):
    return mx.rounded(mx.ranking_by_class(mx.one_vs_rest(fx.predictions(spark, d), LABEL)))


@query("auc_macro_ovr", sql(_long() + _auc("long") + "SELECT round(CAST(avg(auc) AS DOUBLE), 6) AS roc_auc_macro_ovr FROM aucs", "preds"))
def auc_macro_ovr(spark, d):
    by_class = mx.ranking_by_class(mx.one_vs_rest(fx.predictions(spark, d), LABEL))
    return mx.rounded(mx.macro_ranking(by_class).select("roc_auc_macro_ovr"))


@query("average_precision_macro", sql(_long() + _ap("long") + "SELECT round(avg(ap), 6) AS pr_auc_macro FROM aps", "preds"))
def average_precision_macro(spark, d):
    by_class = mx.ranking_by_class(mx.one_vs_rest(fx.predictions(spark, d), LABEL))
    return mx.rounded(mx.macro_ranking(by_class, fixed_classes=True).select("pr_auc_macro"))


@query("confusion_matrix", sql("""
    SELECT a AS actual, p AS predicted, (SELECT count(*) FROM preds WHERE IS_DELAYED = a AND pred_class = c.p) AS n
    FROM (VALUES (0), (1), (2)) x(a), (VALUES (0), (1), (2)) c(p)""", "preds"))
def confusion_matrix(spark, d):
    return mx.confusion_matrix(preds(spark, d), LABEL, "pred_class")


def _report(where: str = "true") -> str:
    return f"""
    , per AS (SELECT c, (SELECT count(*) FROM preds WHERE {where} AND IS_DELAYED = c AND pred_class = c) AS tp,
                (SELECT count(*) FROM preds WHERE {where} AND pred_class = c) AS called,
                (SELECT count(*) FROM preds WHERE {where} AND IS_DELAYED = c) AS support FROM (VALUES (0), (1), (2)) x(c))
    , scored AS (SELECT *, CASE WHEN called = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / called END AS pr,
                   CASE WHEN support = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / support END AS rc,
                   CASE WHEN called + support = 0 THEN 0 ELSE 2.0 * CAST(tp AS DOUBLE) / (called + support) END AS f
                 FROM per WHERE called + support > 0)
    , report AS (SELECT CAST(sum(tp) AS DOUBLE) / sum(support) AS accuracy, avg(pr) AS precision_macro, avg(rc) AS recall_macro,
                   avg(f) AS f1_macro, sum(pr * support) / sum(support) AS precision_weighted,
                   sum(rc * support) / sum(support) AS recall_weighted, sum(f * support) / sum(support) AS f1_weighted FROM scored)"""


@query("classification_report", sql(_report() + """
    SELECT round(accuracy, 6) AS accuracy, round(accuracy, 6) AS precision_micro, round(accuracy, 6) AS recall_micro,
           round(accuracy, 6) AS f1_micro, round(precision_macro, 6) AS precision_macro, round(recall_macro, 6) AS recall_macro,
           round(f1_macro, 6) AS f1_macro, round(precision_weighted, 6) AS precision_weighted,
           round(recall_weighted, 6) AS recall_weighted, round(f1_weighted, 6) AS f1_weighted FROM report""", "preds"))
def classification_report(spark, d):
    return mx.rounded(mx.classification_report(preds(spark, d), LABEL, "pred_class"))


def _kappa(where: str = "true") -> str:
    return f"""
    , seen AS (SELECT IS_DELAYED AS a, pred_class AS b, count(*) AS n FROM preds WHERE {where} GROUP BY ALL)
    , rows_a AS (SELECT a, sum(n) AS n FROM seen GROUP BY a), rows_b AS (SELECT b, sum(n) AS n FROM seen GROUP BY b)
    , kappa AS (SELECT 1 - CAST((SELECT sum((a - b) * (a - b) * n) FROM seen) AS DOUBLE)
          / (SELECT sum(power(a - b, 2) * rows_a.n * rows_b.n / (SELECT sum(n) FROM seen)) FROM rows_a, rows_b) AS qwk)"""


@query("quadratic_kappa", sql(_kappa() + "SELECT round(qwk, 6) AS qwk FROM kappa", "preds"))
def quadratic_kappa(spark, d):
    return mx.rounded(mx.quadratic_kappa(preds(spark, d), LABEL, "pred_class"))


def _binary_cells(source: str, threshold: float) -> str:
    return f"""
    , cells AS (SELECT count(*) FILTER (WHERE y = 1 AND s >= {threshold}) AS tp, count(*) FILTER (WHERE y = 0 AND s < {threshold}) AS tn,
                  count(*) FILTER (WHERE y = 0 AND s >= {threshold}) AS fp, count(*) FILTER (WHERE y = 1 AND s < {threshold}) AS fn FROM {source})
    , binary_report AS (SELECT (SELECT CAST(auc AS DOUBLE) FROM aucs WHERE class = 1) AS auc_roc, CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
          CASE WHEN tp + fp = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS "precision",
          CASE WHEN tp + fn = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
          (2.0 * tp / (2 * tp + fp + fn) + 2.0 * tn / (2 * tn + fp + fn)) / 2 AS f1_macro,
          (2.0 * tp / (2 * tp + fp + fn) * (tp + fn) + 2.0 * tn / (2 * tn + fp + fn) * (tn + fp)) / (tp + tn + fp + fn) AS f1_weighted,
          tp, tn, fp, fn FROM cells)"""


@query("binary_metrics", sql(_BINARY + ", long AS (SELECT 1 AS class, s AS score, y AS hit FROM b)" + _auc("long") + _binary_cells("b", 0.5) + """
    SELECT round(auc_roc, 6) AS auc_roc, round(accuracy, 6) AS accuracy, round("precision", 6) AS "precision", round(recall, 6) AS recall,
           round(CAST(f1_macro AS DOUBLE), 6) AS f1_macro, round(CAST(f1_weighted AS DOUBLE), 6) AS f1_weighted, tp, tn, fp, fn FROM binary_report""", "preds"))
def binary_metrics(spark, d):
    return mx.rounded(mx.binary_metrics(binary(spark, d), "label", "default_proba"))


@query("gini", sql(_BINARY + ", long AS (SELECT 1 AS class, s AS score, y AS hit FROM b)" + _auc("long") +
                   "SELECT round(2 * CAST(auc AS DOUBLE) - 1, 6) AS gini FROM aucs", "preds"))
def gini(spark, d):
    counts = mx.binary_scores(binary(spark, d), "label", "default_proba")
    return mx.rounded(mx.ranking_by_class(counts).select(mx.gini(F.col("auc")).alias("gini")))


@query("score_summary", sql("""
    SELECT count(default_proba) AS sample_size, min(default_proba) AS score_min, round(max(default_proba), 6) AS score_max,
           round(avg(default_proba), 6) AS score_mean, round(stddev_samp(default_proba), 6) AS score_std FROM fx_scores""", "fx_scores"))
def score_summary(spark, d):
    return mx.rounded(mx.score_summary(runs.standard_scores(fx.scores(spark, d)), "default_proba"))


@query("max_proba_summary", sql("""
    SELECT count(*) AS sample_size, round(min(m), 6) AS prob_max_min, round(max(m), 6) AS prob_max_max, round(avg(m), 6) AS prob_max_mean,
           round(stddev_pop(m), 6) AS prob_max_std FROM (SELECT greatest(proba_0, proba_1, proba_2) AS m FROM preds)""", "preds"))
def max_proba_summary(spark, d):
    return mx.rounded(mx.max_proba_summary(fx.predictions(spark, d)))


def _drift(reference: str, current: str) -> str:
    probs = ", ".join(f"CAST({i / 10} AS DOUBLE)" for i in range(11))
    return f"""
    , mp AS (SELECT snapshot_date, greatest(proba_0, proba_1, proba_2) AS m FROM preds)
    , ref AS (SELECT m FROM mp WHERE {reference}), cur AS (SELECT m FROM mp WHERE {current})
    , edges AS (SELECT DISTINCT e FROM (SELECT unnest(quantile_cont(m, [{probs}])) AS e FROM ref))
    , bins AS (SELECT e AS low, lead(e) OVER (ORDER BY e) AS high FROM edges QUALIFY high IS NOT NULL)
    , top AS (SELECT max(high) AS t, count(*) AS k FROM bins)
    , hist AS (SELECT low, (SELECT count(*) FROM ref WHERE m >= low AND (m < high OR (high = t AND m = high))) AS r,
                 (SELECT count(*) FROM cur WHERE m >= low AND (m < high OR (high = t AND m = high))) AS c FROM bins, top)
    , shares AS (SELECT (r + 1e-6) / ((SELECT sum(r) FROM hist) + 1e-6 * k) AS r, (c + 1e-6) / ((SELECT sum(c) FROM hist) + 1e-6 * k) AS c FROM hist, top)
    , psi AS (SELECT CASE WHEN (SELECT count(*) FROM ref) >= 50 AND (SELECT count(*) FROM cur) >= 50 AND (SELECT count(*) FROM edges) >= 3
                          THEN sum((c - r) * ln(c / r)) END AS psi FROM shares)
    , pts AS (SELECT m, sum(r) AS r, sum(c) AS c FROM (SELECT m, 1 AS r, 0 AS c FROM ref UNION ALL SELECT m, 0, 1 FROM cur) GROUP BY m)
    , ks AS (SELECT max(abs(CAST(sum_r AS DOUBLE) / (SELECT count(*) FROM ref) - CAST(sum_c AS DOUBLE) / (SELECT count(*) FROM cur))) AS ks
             FROM (SELECT sum(r) OVER (ORDER BY m) AS sum_r, sum(c) OVER (ORDER BY m) AS sum_c FROM pts))"""


_EARLY, _LATE = "snapshot_date < DATE '2025-01-21'", "snapshot_date >= DATE '2025-01-21'"
_PAST = f"snapshot_date BETWEEN DATE '{DAY}' - INTERVAL 14 DAY AND DATE '{DAY}' - INTERVAL 1 DAY"
_TODAY = f"snapshot_date = DATE '{DAY}'"


def halves(spark, d):
    early = F.col("snapshot_date") < F.lit("2025-01-21").cast("date")
    return stage(drift.score_counts(fx.predictions(spark, d), mx.max_probability(), early, ~early), "scores")


@query("psi", sql(_drift(_EARLY, _LATE) + "SELECT round(psi, 6) AS psi FROM psi", "preds"))
def psi(spark, d):
    return mx.rounded(drift.psi(halves(spark, d)))


@query("ks_statistic", sql(_drift(_EARLY, _LATE) + "SELECT round(ks, 6) AS ks FROM ks", "preds"))
def ks_statistic(spark, d):
    return mx.rounded(drift.ks_statistic(halves(spark, d)))


@query("drift_14d", sql(_drift(_PAST, _TODAY) + "SELECT round(psi, 6) AS psi_max_proba, round(ks, 6) AS ks_max_proba FROM psi, ks", "preds"))
def drift_14d(spark, d):
    return mx.rounded(drift.drift_report(fx.predictions(spark, d), DAY))


@query("monitor_report", sql(
    _long(_TODAY) + _auc("long") + _ap("long") + _report(_TODAY) + _kappa(_TODAY) + _drift(_PAST, _TODAY) + """
    SELECT metric, round(CAST(value AS DOUBLE), 6) AS value FROM (
      SELECT 'perf_roc_auc_macro_ovr' AS metric, (SELECT avg(auc) FROM aucs) AS value
      UNION ALL SELECT 'perf_pr_auc_macro', (SELECT avg(ap) FROM aps)
      UNION ALL SELECT 'perf_accuracy', accuracy FROM report UNION ALL SELECT 'perf_precision_macro', precision_macro FROM report
      UNION ALL SELECT 'perf_recall_macro', recall_macro FROM report UNION ALL SELECT 'perf_f1_macro', f1_macro FROM report
      UNION ALL SELECT 'perf_f1_weighted', f1_weighted FROM report UNION ALL SELECT 'perf_qwk', qwk FROM kappa
      UNION ALL SELECT 'psi_max_proba', psi FROM psi UNION ALL SELECT 'ks_max_proba', ks FROM ks) WHERE value IS NOT NULL""", "preds"))
def monitor_report(spark, d):
    return mx.rounded(jobs.monitor_report(preds(spark, d), DAY))


@query("monthly_labels", sql(f"""
    SELECT Customer_ID, snapshot_date, coalesce(label, 0) AS label FROM last_labels WHERE snapshot_date = DATE '{MONTH}'""", "last_labels"))
def monthly_labels(spark, d):
    return runs.monthly_labels(fx.labels(spark, d), MONTH, "load_order")


_NEWEST = f"""
    , newest AS (SELECT run_id FROM fx_runs WHERE status = 'FINISHED' AND run_id IN
                   (SELECT run_id FROM fx_scores WHERE snapshot_date = DATE '{MONTH}') ORDER BY start_time DESC, run_id DESC LIMIT 1)
    , chosen AS (SELECT * FROM fx_scores WHERE snapshot_date = DATE '{MONTH}' AND run_id = (SELECT run_id FROM newest))"""


@query("latest_run_for_month", sql(_NEWEST + "SELECT * FROM chosen", "fx_scores", "fx_runs"))
def latest_run_for_month(spark, d):
    return runs.latest_run_for_month(fx.runs(spark, d), fx.scores(spark, d), MONTH)


@query("best_run", sql("""
    SELECT run_id, train_date, round(metric_value, 6) AS metric_value, auc_test, auc_test >= 0.7 AS promote FROM fx_runs
    WHERE status = 'FINISHED' AND metric_value IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY train_date ORDER BY metric_value DESC, run_id) = 1""", "fx_runs"))
def best_run(spark, d):
    rows = runs.best_run(fx.runs(spark, d), "metric", min_test_auc=0.7)
    return rows.select("run_id", "train_date", F.round("metric_value", 6).alias("metric_value"), "auc_test", "promote")


def _decision(rule: str) -> str:
    return f"""
    , days AS (SELECT DISTINCT FlightDate AS day FROM dated)
    , prod AS (SELECT DISTINCT CAST(date_trunc('quarter', FlightDate) AS DATE) AS train_date FROM dated
               WHERE month(FlightDate) > 6)
    , joined AS (SELECT day, (SELECT max(train_date) FROM prod WHERE train_date <= day) AS production_date FROM days)
    SELECT day, production_date, CASE WHEN production_date IS NULL OR {rule} THEN 'retrain' ELSE 'infer' END AS decision FROM joined"""


def promotions(spark, d):
    """A model goes into production at the start of every quarter of the second half-year."""
    rows = dated(spark, d)
    days = rows.select(F.col("FlightDate").alias("day")).distinct()
    return days, rows.where("MONTH > 6").select(F.trunc("FlightDate", "QUARTER").alias("train_date"))


@query("retrain_decision", sql(_decision("date_diff('month', date_trunc('month', production_date), date_trunc('month', day)) >= 2"), "dated"))
def retrain_decision(spark, d):
    return runs.retrain_decision(*promotions(spark, d))


@query("retrain_decision_days", sql(_decision("date_diff('day', production_date, day) >= 60"), "dated"))
def retrain_decision_days(spark, d):
    return runs.retrain_decision(*promotions(spark, d), rule="days")


@query("monthly_monitor", sql(
    _NEWEST + f""", b AS (SELECT coalesce(l.label, 0) AS y, coalesce(c.default_proba, 0) AS s FROM chosen c
        JOIN last_labels l ON l.Customer_ID = c.Customer_ID AND l.snapshot_date = c.snapshot_date)
    , long AS (SELECT 1 AS class, s AS score, y AS hit FROM b)""" + _auc("long") + _binary_cells("b", 0.5) + """
    , some_report AS (SELECT * FROM binary_report WHERE tp + tn + fp + fn > 0)
    SELECT metric, round(CAST(value AS DOUBLE), 6) AS value FROM (
      SELECT 'auc_roc' AS metric, auc_roc AS value FROM some_report UNION ALL SELECT 'accuracy', accuracy FROM some_report
      UNION ALL SELECT 'precision', "precision" FROM some_report UNION ALL SELECT 'recall', recall FROM some_report
      UNION ALL SELECT 'f1_macro', f1_macro FROM some_report UNION ALL SELECT 'f1_weighted', f1_weighted FROM some_report
      UNION ALL SELECT 'tp', tp FROM some_report UNION ALL SELECT 'tn', tn FROM some_report
      UNION ALL SELECT 'fp', fp FROM some_report UNION ALL SELECT 'fn', fn FROM some_report
      UNION ALL SELECT 'gini', 2 * auc_roc - 1 FROM some_report
      UNION ALL SELECT 'sample_size', count(default_proba) FROM chosen UNION ALL SELECT 'score_min', min(default_proba) FROM chosen
      UNION ALL SELECT 'score_max', max(default_proba) FROM chosen UNION ALL SELECT 'score_mean', avg(default_proba) FROM chosen
      UNION ALL SELECT 'score_std', stddev_samp(default_proba) FROM chosen)""", "fx_scores", "fx_runs", "last_labels"))
def monthly_monitor(spark, d):
    report = jobs.monthly_monitor(fx.runs(spark, d), fx.scores(spark, d), fx.labels(spark, d), MONTH, "load_order")
    return mx.rounded(report)
