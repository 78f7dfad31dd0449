"""Splits, sampling, encodings, fitting and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from delayworks.operators import cleaning, models, prep, runs
from delayworks.operators import metrics as mx
from delayworks.plans import fixtures as fx
from delayworks.plans import jobs
from delayworks.plans.catalog import flights as fl
from delayworks.plans.catalog import joining
from delayworks.plans.oracle import GOLD_COLUMNS, KEY, sql
from delayworks.plans.registry import query
from delayworks.sources.staging import stage

KEYS = list(KEY)
KEY_SQL = ", ".join(KEY)
HASH = f"md5(concat_ws('|', {KEY_SQL}))"
NUMERIC = ["CRS_DEP_TIME", "DISTANCE", "ACTUAL_ELAPSED_TIME"]


def labelled(spark, d, *extra):
    """Stored silver flights with their delay class."""
    rows = fl.silver(spark, d).withColumn("IS_DELAYED", fl.fn.delay_class())
    return stage(rows.select(*KEYS, "IS_DELAYED", *extra), "labelled")


@query("coerce_dates", sql("""
    SELECT state, o_orderkey, order_day, label FROM (
      SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_day,
             CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 3 AS INT) END AS label FROM orders),
      LATERAL (SELECT CASE WHEN order_day IS NOT NULL AND label IS NOT NULL THEN 'kept' ELSE 'set_aside' END AS state)"""))
def coerce_dates(spark, d):
    """Dates as days, as times and as text that is no date; labels as text."""
    day = F.col("o_orderdate").cast("date").cast("string")
    k = F.col("o_orderkey") % 5
    raw = fx.table(spark, d, "orders").select(
        "o_orderkey",
        F.when(k == 4, "soon").when(k == 3, F.concat(day, F.lit(" 10:20:30.123"))).when(k == 2, F.concat(day, F.lit("T23:59:59")))
        .otherwise(day).alias("order_day"),
        F.when(F.col("o_orderkey") % 7 != 0, (F.col("o_orderkey") % 3).cast("string")).alias("label"))
    kept, aside = cleaning.coerce_dates(raw, "order_day", "label")
    return kept.select(F.lit("kept").alias("state"), "*").unionByName(aside.select(F.lit("set_aside").alias("state"), "*"))


_SPLIT = """
    , m AS (SELECT date_trunc('month', max(FlightDate)) AS last FROM dated)
    , split_rows AS (SELECT dated.*, date_trunc('month', FlightDate) AS mth, CASE
          WHEN date_trunc('month', FlightDate) > last - INTERVAL 6 MONTH THEN 'test'
          WHEN date_trunc('month', FlightDate) > last - INTERVAL 9 MONTH THEN 'val' ELSE 'train' END AS split
        FROM dated, m WHERE date_trunc('month', FlightDate) > last - INTERVAL 24 MONTH)"""


@query("time_split", sql(_SPLIT + f"SELECT {KEY_SQL}, split FROM split_rows", "dated"))
def time_split(spark, d):
    return prep.time_split(fl.dated(spark, d), "FlightDate", 24, 3, 6).select(*KEYS, "split")


@query("split_summary", sql(_SPLIT + """
    SELECT split, count(*) AS n_rows, count(*) FILTER (WHERE y = 0) AS class_0, count(*) FILTER (WHERE y = 1) AS class_1,
           count(*) FILTER (WHERE y = 2) AS class_2, CAST(min(mth) AS DATE) AS first_month, CAST(max(mth) AS DATE) AS last_month
    FROM (SELECT *, CASE WHEN greatest(coalesce(DEP_DELAY_NEW, 0), coalesce(ARR_DELAY_NEW, 0)) >= 120 THEN 2
                         WHEN greatest(coalesce(DEP_DELAY_NEW, 0), coalesce(ARR_DELAY_NEW, 0)) >= 60 THEN 1 ELSE 0 END AS y FROM split_rows)
    GROUP BY split""", "dated"))
def split_summary(spark, d):
    rows = fl.dated(spark, d).withColumn("IS_DELAYED", fl.fn.delay_class())
    return prep.split_summary(prep.time_split(rows, "FlightDate", 24, 3, 6), "FlightDate", "IS_DELAYED")


@query("oot_split", sql("""
    SELECT feature_id, label_snapshot_date, CASE WHEN label_snapshot_date >= DATE '1999-08-01' THEN 'oot' ELSE 'train_test' END AS split
    FROM fx_features WHERE label_snapshot_date >= DATE '1998-08-01' AND label_snapshot_date < DATE '1999-10-01'""", "fx_features"))
def oot_split(spark, d):
    rows = prep.oot_split(fx.features(spark, d), "label_snapshot_date", "1999-10-01", 12, 2)
    return rows.select("feature_id", "label_snapshot_date", "split")


_CLASSED = f"""
    , classed AS (SELECT {KEY_SQL}, IS_DELAYED, row_number() OVER (PARTITION BY IS_DELAYED ORDER BY {HASH}) AS r,
                         count(*) OVER (PARTITION BY IS_DELAYED) AS n FROM gold)"""


@query("stratified_split", sql(_CLASSED + f"""
    SELECT {KEY_SQL}, IS_DELAYED, CASE WHEN r <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM classed""", "gold"))
def stratified_split(spark, d):
    return prep.stratified_split(labelled(spark, d), KEYS, "IS_DELAYED", 0.8)


@query("downsample_majority", sql(_CLASSED + f"""
    SELECT {KEY_SQL}, IS_DELAYED FROM classed WHERE IS_DELAYED <> 0 OR r <= floor(n * CAST(0.2 AS DOUBLE))""", "gold"))
def downsample_majority(spark, d):
    return prep.downsample_majority(labelled(spark, d), KEYS, "IS_DELAYED")


@query("row_cap", sql(f"SELECT {KEY_SQL}, IS_DELAYED FROM gold ORDER BY {HASH} LIMIT 5000", "gold"))
def row_cap(spark, d):
    return prep.row_cap(labelled(spark, d), KEYS, 5000)


@query("class_weights", sql(f"""
    SELECT {KEY_SQL}, IS_DELAYED, round(count(*) OVER () / (3.0 * count(*) OVER (PARTITION BY IS_DELAYED)), 6) AS weight FROM gold""", "gold"))
def class_weights(spark, d):
    rows = prep.class_weights(labelled(spark, d), "IS_DELAYED")
    return rows.withColumn("weight", F.round("weight", 6))


def customers(spark, d):
    """Features with a training part: the months before 1999."""
    rows = fx.features(spark, d).withColumn("fe_1", F.col("fe_1").try_cast("double"))
    return rows, rows.where("label_snapshot_date < date '1999-01-01'")


_NUM = ", num AS (SELECT * REPLACE (TRY_CAST(fe_1 AS DOUBLE) AS fe_1) FROM fx_features), tr AS (SELECT * FROM num WHERE label_snapshot_date < DATE '1999-01-01') "


@query("impute_median", sql(_NUM + """
    SELECT feature_id, coalesce(fe_1, (SELECT quantile_cont(fe_1, 0.5) FROM tr)) AS fe_1,
           round(coalesce(fe_2, (SELECT quantile_cont(fe_2, 0.5) FROM tr)), 6) AS fe_2 FROM num""", "fx_features"))
def impute_median(spark, d):
    rows, train = customers(spark, d)
    return prep.impute_median(rows, train, ["fe_1", "fe_2"]).select("feature_id", "fe_1", F.round("fe_2", 6).alias("fe_2"))


@query("impute_mode", sql(_NUM + """
    SELECT feature_id, coalesce(Occupation, (SELECT Occupation FROM tr WHERE Occupation IS NOT NULL GROUP BY 1
           ORDER BY count(*) DESC, Occupation LIMIT 1)) AS Occupation FROM num""", "fx_features"))
def impute_mode(spark, d):
    rows, train = customers(spark, d)
    return prep.impute_mode(rows, train, ["Occupation"]).select("feature_id", "Occupation")


@query("one_hot", sql("""
    SELECT feature_id, Occupation, CASE WHEN Occupation = 'Doctor' THEN 1 ELSE 0 END AS Occupation_Doctor,
           CASE WHEN Occupation = 'Lawyer' THEN 1 ELSE 0 END AS Occupation_Lawyer,
           CASE WHEN Occupation = 'Teacher' THEN 1 ELSE 0 END AS Occupation_Teacher,
           CASE WHEN Occupation = 'Writer' THEN 1 ELSE 0 END AS Occupation_Writer FROM fx_features""", "fx_features"))
def one_hot(spark, d):
    rows, train = customers(spark, d)
    return prep.one_hot(rows.select("feature_id", "Occupation"), train, "Occupation")


@query("one_hot_dictionary", sql(_NUM + """
    , values_ AS (SELECT Customer_ID, row_number() OVER (ORDER BY Customer_ID) - 1 AS i, count(*) OVER () AS n
                  FROM (SELECT DISTINCT Customer_ID FROM tr WHERE Customer_ID IS NOT NULL))
    SELECT f.feature_id, (SELECT count(*) FROM values_) AS size, v.i AS index FROM fx_features f LEFT JOIN values_ v ON f.Customer_ID = v.Customer_ID""", "fx_features"))
def one_hot_dictionary(spark, d):
    """A column with many values as sparse one-hot vectors; its dictionary never meets on the driver."""
    rows, train = customers(spark, d)
    hot = prep.one_hot_sparse(rows.select("feature_id", "Customer_ID"), prep.fit_dictionary(train, "Customer_ID"), "Customer_ID")
    return hot.select("feature_id", "Customer_ID_hot.size", F.get("Customer_ID_hot.indices", F.lit(0)).alias("index"))


@query("standard_scale", sql(_NUM + """
    SELECT feature_id, round((fe_2 - (SELECT avg(fe_2) FROM tr)) / (SELECT stddev_pop(fe_2) FROM tr), 6) AS fe_2_scaled,
           round((fe_3 - (SELECT avg(fe_3) FROM tr)) / (SELECT stddev_pop(fe_3) FROM tr), 6) AS fe_3_scaled FROM num""", "fx_features"))
def standard_scale(spark, d):
    rows, train = customers(spark, d)
    scaled = prep.standard_scale(rows, train, ["fe_2", "fe_3"])
    return scaled.select("feature_id", *[F.round(c, 6).alias(c) for c in ("fe_2_scaled", "fe_3_scaled")])


@query("quantile_cap", sql(_NUM + """
    SELECT feature_id, round(CASE WHEN fe_2 IS NOT NULL THEN greatest((SELECT quantile_cont(fe_2, 0.01) FROM tr),
             least((SELECT quantile_cont(fe_2, 0.99) FROM tr), fe_2)) END, 6) AS fe_2,
           round(greatest((SELECT quantile_cont(CAST(fe_3 AS DOUBLE), 0.01) FROM tr),
             least((SELECT quantile_cont(CAST(fe_3 AS DOUBLE), 0.99) FROM tr), CAST(fe_3 AS DOUBLE))), 6) AS fe_3 FROM num""", "fx_features"))
def quantile_cap(spark, d):
    rows, train = customers(spark, d)
    capped = prep.quantile_cap(rows, train, ["fe_2", "fe_3"])
    return capped.select("feature_id", F.round("fe_2", 6).alias("fe_2"), F.round("fe_3", 6).alias("fe_3"))


_LIST = [("feature_id", "none", "excluded"), ("Customer_ID", "none", "excluded"), ("label_snapshot_date", "none", "excluded"),
         ("Occupation", "categorical", "ok"), ("Age_bin", "categorical", "extra"), ("fe_1", "categorical", "extra"),
         ("fe_2", "numeric", "ok"), ("fe_3", "numeric", "ok")]


@query("feature_list", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{k}' AS kind, '{s}' AS status, count(\"{c}\") AS n_values FROM fx_features" for c, k, s in _LIST)
    + " UNION ALL SELECT 'fe_9', 'none', 'missing', CAST(0 AS BIGINT)", "fx_features"))
def feature_list(spark, d):
    return prep.feature_list(fx.features(spark, d), ("feature_id", "Customer_ID"), trained=["Occupation", "fe_2", "fe_3", "fe_9"])


# --- fitting ------------------------------------------------------------------

LABEL = "IS_DELAYED"


# Rounds and trials of the registered queries. A search of the library draws 20 settings of 300 to 600 rounds by default;
# here it draws three settings of few rounds, so that a query ends in a minute on one machine (README has the figures of
# the full budget). The search over regularisation runs in full.
ROUNDS, DEPTH, TRIALS = 5, 4, 3
SHORT = {"maxIter": (4, 8), "maxDepth": (3, 4)}


def training_rows(spark, d):
    """Stored gold flights: their keys, features and label."""
    gold = fl.gold(spark, d)
    numeric, text = prep.feature_columns(gold, exclude=(LABEL, "FlightDate", "TAIL_NUM", "year_month"))
    gold = stage(gold.select(*dict.fromkeys((*KEYS, "snapshot_date", "flight_id", *numeric, *text, LABEL))), "gold")
    return models.as_doubles(gold, numeric), numeric, text


@query("train_multiclass")
def train_multiclass(spark, d):
    gold = joining.combined(spark, d, keep_leg=True)  # training stores what it uses of it
    _, _, report = jobs.training_metrics(gold, months=(24, 3, 6), keys=(*KEYS, "leg"), maxIter=ROUNDS, maxDepth=DEPTH)
    return mx.rounded(report)


@query("feature_importance")
def feature_importance(spark, d):
    rows, numeric, text = training_rows(spark, d)
    train = prep.class_weights(rows, LABEL)
    model = models.fit_multiclass(train, LABEL, numeric, text, maxIter=ROUNDS, maxDepth=DEPTH)
    return models.feature_importance(model, model.transform(train))


_USED = [c for c in GOLD_COLUMNS if c not in (*prep.ID_LIKE, *prep.LEAKAGE, LABEL, "FlightDate", "TAIL_NUM", "year_month", "snapshot_date")]


@query("feature_importance_check", sql(f"""
    SELECT feature, true AS share, true AS sums_to_one FROM (SELECT unnest({_USED}) AS feature), (SELECT count(*) AS n FROM gold) WHERE n > 0""", "gold"))
def feature_importance_check(spark, d):
    """One row per source column, encoded ones summed over their values; the shares sum to 1."""
    shares = feature_importance(spark, d)
    total = shares.agg(F.sum("importance").alias("total"))
    return shares.join(total).select("feature", F.col("importance").between(0, 1).alias("share"), (F.abs(F.col("total") - 1) < 1e-9).alias("sums_to_one"))


@query("score_multiclass")
def score_multiclass(spark, d):
    rows, numeric, text = training_rows(spark, d)
    train = prep.class_weights(rows.where("FlightDate < date '2001-01-01'"), LABEL)
    model = models.fit_multiclass(train, LABEL, numeric, text, maxIter=ROUNDS, maxDepth=DEPTH)
    scored = models.score_multiclass(model, rows.where("FlightDate >= date '2001-01-01'"), ["snapshot_date", "flight_id"], LABEL)
    return scored.drop("predicted_at")


@query("score_multiclass_check", sql("""
    SELECT snapshot_date, flight_id, IS_DELAYED, true AS sums_to_one, true AS most_probable FROM gold WHERE FlightDate >= DATE '2001-01-01'""", "gold"))
def score_multiclass_check(spark, d):
    """One scored row per flight: its probabilities sum to 1 and the class is the most probable one."""
    scored = score_multiclass(spark, d)
    top = F.greatest(*mx.PROBABILITIES)
    named = F.element_at(F.array(*mx.PROBABILITIES), F.col("pred_class").cast("int") + 1)
    return scored.select("snapshot_date", "flight_id", LABEL, (F.abs(sum((F.col(c) for c in mx.PROBABILITIES), F.lit(0.0)) - 1) < 1e-9).alias("sums_to_one"),
                         (named == top).alias("most_probable"))


@query("tune_multiclass")
def tune_multiclass(spark, d):
    rows, numeric, text = training_rows(spark, d)
    train = stage(prep.class_weights(rows, LABEL), "train")
    _, trials = models.tune_multiclass(train, LABEL, numeric, text, KEYS, models.random_settings(TRIALS, SHORT))
    return trials


def binary_rows(spark, d):
    rows = joining.features_labels_inner(spark, d).where("label is not null")
    rows = models.as_doubles(prep.coerce_numeric(rows, ("feature_id", "Customer_ID", "label_snapshot_date", "Occupation", "Age_bin")),
                             ["fe_1", "fe_2", "fe_3", "label"])
    return stage(rows, "binary"), ["fe_1", "fe_2", "fe_3"], ["Occupation", "Age_bin"]


@query("tune_logreg")
def tune_logreg(spark, d):
    rows, numeric, text = binary_rows(spark, d)
    train = stage(prep.class_weights(rows, "label"), "train")
    _, trials = models.tune_logreg(train, "label", numeric, text, ["feature_id"])
    return trials


@query("tune_logreg_check", sql("""
    SELECT CAST(i AS INT) AS trial, 'regParam' AS param, round(1.0 / (10 ** (-2 + 4 * i / 19.0) * n), 12) AS param_value, true AS is_auc, true AS best_is_highest
    FROM (SELECT count(*) AS n FROM (SELECT f.*, l.label FROM fx_features f JOIN last_labels l ON f.Customer_ID = l.Customer_ID
          AND f.label_snapshot_date = l.snapshot_date) WHERE label IS NOT NULL), range(20) r(i)""", "fx_features", "last_labels"))
def tune_logreg_check(spark, d):
    """All twenty strengths are tried; the one called best has the highest objective."""
    trials = tune_logreg(spark, d)
    top = trials.agg(F.max("objective").alias("top"))
    return trials.join(top).select("trial", "param", F.round(F.col("param_value").cast("double"), 12).alias("param_value"),
                                   F.col("objective").between(0, 1).alias("is_auc"), (F.col("best") == (F.col("objective") == F.col("top"))).alias("best_is_highest"))


@query("train_binary")
def train_binary(spark, d):
    rows, numeric, text = binary_rows(spark, d)
    split = stage(prep.stratified_split(rows, ["feature_id"], "label"), "split")
    model, _ = models.tune_binary(stage(split.where("split = 'train'"), "train"), "label", numeric, text, ["feature_id"],
                                  models.random_settings(TRIALS, SHORT))
    scored = models.with_default_probability(model.transform(split.where("split = 'test'")))
    return mx.rounded(mx.binary_metrics(stage(scored.select("label", "default_proba"), "scored"), "label", "default_proba"))


def credit_model(spark, d):
    labels = runs.latest_label(fx.labels(spark, d), "load_order").select("Customer_ID", "snapshot_date", "label")
    return jobs.credit_training(fx.features(spark, d), labels, "2000-01-01", 36, 6, ["fe_1", "fe_2", "fe_3"],
                                ["Occupation", "Age_bin"], "feature_id")


@query("train_logreg")
def train_logreg(spark, d):
    _, _, report = credit_model(spark, d)
    return mx.rounded(report)


@query("score_binary")
def score_binary(spark, d):
    model, _, _ = credit_model(spark, d)
    return jobs.credit_scores(model, fx.features(spark, d), "2000-02-01").drop("scored_at")


@query("score_binary_check", sql("""
    SELECT Customer_ID, label_snapshot_date, true AS in_range, true AS flag_agrees FROM fx_features
    WHERE label_snapshot_date = DATE '2000-02-01'""", "fx_features"))
def score_binary_check(spark, d):
    """One scored row per customer of the day, nulls filled as in training; the flag follows the probability."""
    p = F.col("default_proba")
    return score_binary(spark, d).select("Customer_ID", "label_snapshot_date", p.between(0, 1).alias("in_range"),
                                         ((p >= 0.5).cast("int") == F.col("default")).alias("flag_agrees"))
