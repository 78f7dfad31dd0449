"""Coupled boosting, dictionaries, the search over penalties and resumable runs."""

import math
import random
import threading

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from delayworks.operators import boosting, logistic, models, prep
from delayworks.operators.dictionaries import DictionaryIndexer, fit_indexer
from delayworks.sources.staging import stage
from delayworks.sources.steps import Steps


def three_classes(spark, n=1500, seed=1):
    """Overlapping classes along two numbers, unevenly weighted."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = rng.choices((0, 1, 2), (6, 3, 1))[0]
        rows.append((i, k, rng.gauss(k, 0.8), rng.gauss(-k if k < 2 else 1, 1.0), rng.choice((0.5, 1.0, 2.0)), i % 4 == 0))
    df = spark.createDataFrame(rows, "i long, y int, a double, b double, weight double, held boolean")
    return stage(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df), "rows")


def loss_of(scored, names):
    rows = scored.select("y", "weight", *names).collect()
    return sum(-r.weight * math.log(max(1e-15, r[f"proba_{r.y}"])) for r in rows) / sum(r.weight for r in rows)


def one_against_rest(train, test, rounds):
    """The same number of trees, fitted class by class and normalised."""
    out = test
    for k in range(3):
        trees = GBTClassifier(labelCol="t", featuresCol="features", weightCol="weight", maxIter=rounds, maxDepth=3, stepSize=0.3, seed=1,
                              predictionCol=f"c{k}").setRawPredictionCol(f"r{k}").setProbabilityCol(f"v{k}")
        fitted = trees.fit(train.withColumn("t", (F.col("y") == k).cast("double")))
        out = fitted.transform(out).withColumn(f"q{k}", F.get(vector_to_array(f"v{k}"), F.lit(1)))
    total = F.col("q0") + F.col("q1") + F.col("q2")
    return out.withColumns({f"proba_{k}": F.col(f"q{k}") / total for k in range(3)})


def test_one_softmax_is_no_worse_than_boosters_fitted_apart(spark):
    df = three_classes(spark, 5000)
    train, test = df.where("not held"), df.where("held")
    fit = boosting.fit_softmax(train, "y", (0, 1, 2), maxIter=8, maxDepth=3, stepSize=0.3)
    names = ["proba_0", "proba_1", "proba_2"]
    scored = boosting.boosted_pipeline([], fit).transform(test)
    apart = one_against_rest(train, test, 8)
    assert loss_of(scored, names) <= loss_of(apart, names)
    assert all(abs(sum(r) - 1) < 1e-12 and min(r) >= 0 for r in scored.select(*names).collect())


def test_a_round_is_a_newton_step_per_leaf(spark):
    """A stump on one split: each leaf holds the sum of gradients over the sum of curvatures."""
    rows = [(0, 0.0, 1.0), (0, 0.0, 2.0), (1, 0.0, 1.0), (1, 1.0, 1.0), (2, 1.0, 4.0), (1, 1.0, 0.5)]
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.createDataFrame(rows, "y int, x double, weight double"))
    fit = boosting.fit_softmax(df, "y", (0, 1, 2), maxIter=1, maxDepth=1, stepSize=1.0, childWeight=0.0)
    total = sum(w for *_, w in rows)
    for k, tree in enumerate(fit.rounds[0]):
        p = sum(w for y, _, w in rows if y == k) / total
        assert math.isclose(fit.start[k], math.log(p))
        for x in (0.0, 1.0):
            g = sum(w * ((y == k) - p) for y, v, w in rows if v == x)
            h = sum(w * p * (1 - p) for _, v, w in rows if v == x)
            assert math.isclose(tree.predict(Vectors.dense([x])), g / h, rel_tol=1e-9)


def test_validation_stops_and_keeps_the_best_round(spark):
    df = three_classes(spark, 400)
    fit = boosting.fit_softmax(df, "y", (0, 1, 2), maxIter=60, maxDepth=4, stepSize=0.5, validation="held", patience=3)
    assert len(fit.losses) < 60 and len(fit.losses) - fit.best == 3
    assert fit.losses[fit.best - 1] == min(fit.losses)
    assert math.isclose(loss_of(boosting.boosted_pipeline([], fit).transform(df.where("held")), ["proba_0", "proba_1", "proba_2"]),
                        fit.losses[fit.best - 1], rel_tol=1e-9)


def test_stored_model_scores_alike(spark, tmp_path):
    df = three_classes(spark, 300)
    model = boosting.boosted_pipeline([], boosting.fit_softmax(df, "y", (0, 1, 2), maxIter=10, maxDepth=2))
    model.save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    columns = ["i", "proba_0", "proba_1", "proba_2"]
    assert sorted(map(tuple, model.transform(df).select(*columns).collect())) == sorted(map(tuple, again.transform(df).select(*columns).collect()))


def test_no_rows_and_one_class(spark):
    empty = three_classes(spark, 10).where("false")
    assert boosting.fit_softmax(empty, "y", (0, 1, 2)).rounds == []
    one = three_classes(spark, 40).withColumn("y", F.lit(1))
    scored = boosting.boosted_pipeline([], boosting.fit_softmax(one, "y", (0, 1, 2), maxIter=2)).transform(one)
    assert scored.where("proba_1 < 0.99").count() == 0


def test_dictionary_numbers_values_in_order(spark):
    values = [f"v{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values * 2] + [(None,)], "c string").repartition(7)
    found = prep.fit_dictionary(df, "c", slice_rows=60).collect()
    assert sorted((r["index"], r["value"]) for r in found) == list(enumerate(values))
    asked = spark.createDataFrame([("v0003",), ("new",), (None,)], "c string")
    hot = {r.c: r.c_hot for r in prep.one_hot_sparse(asked, prep.fit_dictionary(df, "c"), "c").collect()}
    assert (hot["v0003"].size, hot["v0003"].indices, hot["v0003"]["values"]) == (500, [3], [1.0]) and hot["new"].indices == [] == hot[None].indices
    with pytest.raises(ValueError, match="more than 100 values"):
        prep.one_hot(df, df, "c", most=100)


def test_a_million_categories_without_a_list(spark):
    df = spark.range(1_000_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("c"))
    stage_ = fit_indexer(df, "c", "c_index")
    assert stage_.getOrDefault(stage_.size) == 1_000_000
    out = stage_.transform(df).agg(F.count_distinct("c_index").alias("n"), F.max("c_index").alias("top")).first()
    assert (out.n, out.top) == (1_000_000, 999_999.0)


def test_wide_columns_go_through_a_dictionary_and_are_saved_with_it(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(models, "wide_columns", lambda train, categorical, most=0: ["w"])
    rng = random.Random(2)
    rows = [(float(i), rng.choice("abcdef"), rng.choice("xyz"), rng.randint(0, 1)) for i in range(200)] + [(1.0, None, None, 1)]
    df = stage(spark.createDataFrame(rows, "n double, w string, f string, label int"), "wide")
    fitted = Pipeline(stages=models.feature_stages(df, ["n"], ["w", "f"])).fit(df)
    assert any(isinstance(s, DictionaryIndexer) for s in fitted.stages)
    fitted.save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert models.trained_columns(again) == (["n"], ["f", "w"])
    asked = df.unionByName(spark.createDataFrame([(0.5, "new", "x", 0)], df.schema))
    rows_of = lambda m: sorted((r.n, tuple(r.v)) for r in m.transform(asked).select("n", vector_to_array("features").alias("v")).collect())
    assert rows_of(again) == rows_of(fitted)
    monkeypatch.undo()
    plain = Pipeline(stages=models.feature_stages(df, ["n"], ["w", "f"])).fit(df)
    assert rows_of(plain) == rows_of(fitted)


def test_penalties_fitted_together_equal_the_library_one_by_one(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((a, b, int(rng.random() < 1 / (1 + math.exp(-(a - 0.5 * b + 0.3)))), rng.choice((0.5, 2.0)), i % 3))
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, "a double, b double, label int, weight double, fold int"))
    df = stage(df, "rows")
    pairs = [(fold, s) for s in (1e-4, 0.01, 1.0) for fold in (0, 1, 2)]
    beta, passes = logistic.fit_path(df, "label", pairs)
    assert passes < 15
    for k, (fold, s) in enumerate(pairs):
        fit = LogisticRegression(weightCol="weight", regParam=s, elasticNetParam=0.0, standardization=False, maxIter=200, tol=1e-10).fit(df.where(F.col("fold") != fold))
        assert np.allclose(beta[k], [*fit.coefficients, fit.intercept], atol=1e-4)


def test_search_over_penalties_scores_like_the_cross_validator(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(x := rng.gauss(0, 1), rng.choice("pq"), int(x + rng.gauss(0, 1) > 0), i) for i in range(300)]
    df = prep.class_weights(spark.createDataFrame(rows, "x double, g string, label int, i int").withColumn("label", F.col("label").cast("double")), "label")
    df = stage(df, "rows")
    fast = {(r.trial, r.param_value): r.objective for r in models.tune_logreg(df, "label", ["x"], ["g"], ["i"], trials=4)[1].collect()}
    monkeypatch.setattr(logistic, "MOST_FEATURES", 0)
    slow = {(r.trial, r.param_value): r.objective for r in models.tune_logreg(df, "label", ["x"], ["g"], ["i"], trials=4)[1].collect()}
    assert fast.keys() == slow.keys() and all(math.isclose(fast[k], slow[k], abs_tol=2e-3) for k in fast)


def test_importance_is_per_source_column(spark):
    rng = random.Random(5)
    rows = [(float(i % 7), rng.choice(("a", "b_hot_c", "c")), i) for i in range(300)]
    df = spark.createDataFrame(rows, "n double, b string, i int").withColumn("y", F.when(F.col("b") == "a", 0).when(F.col("b") == "c", 2).otherwise(1))
    df = stage(df.withColumn("weight", F.lit(1.0)), "rows")
    model = models.fit_multiclass(df, "y", ["n"], ["b"], maxIter=2, maxDepth=2)
    found = {r.feature: r.importance for r in models.feature_importance(model, model.transform(df)).collect()}
    assert found.keys() == {"n", "b"} and math.isclose(sum(found.values()), 1.0) and found["b"] > 0.9
    assert models.column_of("b_hot_a_hot_x", [], ["b", "b_hot_a"]) == "b_hot_a" and models.column_of("n_filled", ["n"], ["n_filled_"]) == "n"


def test_a_stopped_run_goes_on_from_its_last_step(spark, tmp_path):
    calls = []

    def run(given, fail=False):
        steps = Steps(spark, str(tmp_path / "run"), given)
        table = steps.table("rows", lambda: calls.append("rows") or spark.range(5))
        value = steps.value("score", lambda: calls.append("score") or [table.count(), 0.5])
        if fail:
            raise RuntimeError("stopped")
        model = steps.model("model", lambda: calls.append("model") or Pipeline(stages=[VectorAssembler(inputCols=["id"], outputCol="v")]).fit(table))
        return value, model.transform(table).count(), [r.step for r in steps.manifest().collect()]

    with pytest.raises(RuntimeError):
        run({"a": 1}, fail=True)
    assert calls == ["rows", "score"]
    assert run({"a": 1}) == ([5, 0.5], 5, ["rows", "score", "model"]) and calls == ["rows", "score", "model"]
    assert run({"a": 1})[0] == [5, 0.5] and len(calls) == 3
    run({"a": 2})
    assert len(calls) == 6


def test_a_step_without_its_line_is_done_again(spark, tmp_path):
    steps = Steps(spark, str(tmp_path / "run"), {})
    spark.range(3).write.parquet(f"{steps.root}/half")  # data, but the run stopped before its line
    assert Steps(spark, str(tmp_path / "run"), {}).table("half", lambda: spark.range(4)).count() == 4


def test_search_is_taken_up_where_it_stopped(spark, tmp_path, monkeypatch):
    df = three_classes(spark, 240).drop("features", "held")
    settings = [{"maxIter": 2, "maxDepth": 2}, {"maxIter": 3, "maxDepth": 2}]
    fits, lock, real = [], threading.Lock(), boosting.fit_softmax

    def counted(*args, **kwargs):
        with lock:
            fits.append(kwargs.get("validation"))
            if len(fits) == 4:
                raise RuntimeError("stopped")
        return real(*args, **kwargs)

    monkeypatch.setattr(boosting, "fit_softmax", counted)
    run = lambda: models.tune_multiclass(df, "y", ["a", "b"], [], ["i"], settings, steps=Steps(spark, str(tmp_path / "s"), {"s": 1}))
    with pytest.raises(RuntimeError):
        run()
    before = len(fits)
    model, trials = run()
    assert len(fits) - before <= 5 and trials.count() == 4  # at most four of six folds and the last fit are left
    again = len(fits)
    run()
    assert len(fits) == again and models.with_probabilities(model.transform(df)).count() == 240


def test_credit_scores_equal_a_plain_regression(spark, small):
    """Medians, modes, one-hot columns, scaling and the weighted, penalised fit once more in numpy."""
    from delayworks.operators import joins, runs
    from delayworks.plans import fixtures as fx
    from delayworks.plans import jobs
    from delayworks.plans.catalog import learning

    numbers, texts = ["fe_1", "fe_2", "fe_3"], ["Occupation", "Age_bin"]
    model, trials, _ = learning.credit_model(spark, small)
    penalty = float(trials.where("best").first().param_value)
    labels = runs.latest_label(fx.labels(spark, small), "load_order").select("Customer_ID", "snapshot_date", "label")
    rows = joins.features_with_labels(fx.features(spark, small), labels).where("label is not null")
    rows = rows.withColumns({c: F.col(c).try_cast("double") for c in (*numbers, "label")})
    rows = stage(prep.oot_split(rows, "label_snapshot_date", "2000-01-01", 36, 6), "windows").where("split = 'train_test'").drop("split")
    train = prep.stratified_split(rows, ["feature_id"], "label").where("split = 'train'").toPandas()
    median = {c: train[c].median() for c in numbers}
    mode = {c: sorted(train[c].dropna().value_counts().items(), key=lambda x: (-x[1], x[0]))[0][0] for c in texts}
    values = {c: sorted(train[c].fillna(mode[c]).unique()) for c in texts}

    def design(df):
        columns = [df[c].fillna(median[c]) for c in numbers] + [df[c].fillna(mode[c]) == v for c in texts for v in values[c]]
        return np.column_stack([np.asarray(c, float) for c in columns])

    x, y = design(train), train["label"].to_numpy(float)
    mean, spread = x.mean(axis=0), x.std(axis=0, ddof=1)
    spread[spread == 0] = 1.0
    counts = {k: (y == k).sum() for k in set(y)}
    w = np.array([len(y) / (len(counts) * counts[k]) for k in y])
    z, beta = np.c_[(x - mean) / spread, np.ones(len(y))], np.zeros(x.shape[1] + 1)
    ridge = np.r_[np.full(x.shape[1], penalty), 0.0]
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ beta))
        curve = (z * (w * p * (1 - p))[:, None]).T @ z / w.sum() + np.diag(ridge) + 1e-12 * np.eye(len(beta))
        beta -= logistic.solved(curve, z.T @ (w * (p - y)) / w.sum() + ridge * beta)
    asked = fx.features(spark, small).where("label_snapshot_date = date '2000-02-01'").withColumns({c: F.col(c).try_cast("double") for c in numbers}).toPandas()
    expected = dict(zip(asked["Customer_ID"], 1 / (1 + np.exp(-(np.c_[(design(asked) - mean) / spread, np.ones(len(asked))] @ beta)))))
    got = {r.Customer_ID: r.default_proba for r in jobs.credit_scores(model, fx.features(spark, small), "2000-02-01").collect()}
    assert got.keys() == expected.keys() and len(got) > 3
    assert all(abs(got[k] - expected[k]) < 2e-3 for k in got)


def test_many_rows_are_boosted_alike_from_histograms(spark, monkeypatch):
    """Few distinct values: both ways have the same candidates, so trees, importances and probabilities agree."""
    rng = random.Random(8)
    rows = []
    for i in range(2000):
        a, b, c = rng.randint(0, 20), rng.randint(0, 1), rng.randint(0, 30) / 7
        rows.append((i, rng.choices((0, 1, 2), (4 + a % 5 * b, 2 + c, 1 + 2 * (a > 12)))[0], float(a), float(b), c, rng.choice((0.5, 1.0, 2.0))))
    df = spark.createDataFrame(rows, "i long, y int, a double, b double, c double, weight double").repartition(5)
    df = stage(VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df), "rows")
    monkeypatch.setattr(boosting.histograms, "STORED_EVERY", 2)
    found = []
    for most in (1 << 40, 0):
        monkeypatch.setattr(boosting, "LEARNER_ROWS", most)
        fit = boosting.fit_softmax(df, "y", (0, 1, 2), maxIter=5, maxDepth=4, stepSize=0.3)
        model = boosting.boosted_pipeline([], fit)
        shares = [s.featureImportances.toArray() for s in model.stages if hasattr(s, "featureImportances")]
        found.append((shares, [tuple(r) for r in model.transform(df).select("proba_0", "proba_1", "proba_2").orderBy("i").collect()]))
    assert len(found[0][0]) == 3 and np.allclose(found[0][0], found[1][0], atol=1e-9)
    assert np.allclose(found[0][1], found[1][1], atol=1e-9)


def test_encoded_columns_are_one_code_each_in_histograms(spark, monkeypatch):
    """A category is one byte a row, not one for each of its values; the trees agree with those of the library's learner."""
    rng = random.Random(4)
    rows = []
    for _ in range(1200):
        a, g, h = rng.randint(0, 9), rng.choice("abcdefghijkl"), rng.choice(("x", "y", None))
        rows.append((rng.choices((0, 1, 2), (3 + a, 2 + 6 * (g in "bdk"), 1 + 5 * (h == "x")))[0], float(a), g, h, rng.choice((0.5, 1.0, 2.0))))
    df = stage(spark.createDataFrame(rows, "y int, a double, g string, h string, weight double").repartition(3), "rows")
    stored, real = {}, boosting.histograms.stage
    monkeypatch.setattr(boosting.histograms, "stage", lambda table, name: stored.setdefault(name, real(table, name)))
    found = []
    for most in (1 << 40, 0):
        monkeypatch.setattr(boosting, "LEARNER_ROWS", most)
        model = models.fit_multiclass(df, "y", ["a"], ["g", "h"], maxIter=3, maxDepth=3, stepSize=0.3)
        probed = model.transform(df.select("a", "g", "h").distinct().orderBy("a", "g", "h"))
        found.append([tuple(r) for r in probed.select("proba_0", "proba_1", "proba_2").collect()])
    assert np.allclose(found[0], found[1], atol=1e-9)
    assert {r.n for r in stored["binned"].select(F.octet_length("codes").alias("n")).collect()} == {3}


def test_bins_come_from_all_rows():
    from delayworks.operators import histograms

    rng = np.random.default_rng(1)
    x = rng.normal(size=20_000)
    parts = [histograms.thinned(p, np.ones(len(p)), histograms.POINTS) for p in np.split(x, 4)]
    assert all(len(v) <= histograms.POINTS and math.isclose(w.sum(), 5000) for v, w in parts)
    found = histograms.cuts(*np.concatenate(parts, axis=1), 32)
    assert len(found) == 31 and np.abs(np.searchsorted(np.sort(x), found) / len(x) - np.arange(1, 32) / 32).max() < 2e-3
    assert list(histograms.cuts(np.array([3.0, 1.0, 1.0]), np.ones(3), 32)) == [2.0] and len(histograms.cuts(np.ones(4), np.ones(4), 32)) == 0


def test_held_out_margins_are_dealt_out_by_number(spark, monkeypatch):
    """A row gives a margin for each penalty: one stored file must not mean one task for all of them."""
    rng = random.Random(9)
    rows = [(rng.gauss(0, 1), i % 2, i % 3) for i in range(600)]
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(spark.createDataFrame(rows, "a double, label int, fold int"))
    df = stage(df.coalesce(1), "rows")
    pairs = [(fold, s) for s in (0.1, 1.0, 10.0, 100.0) for fold in (0, 1, 2)]
    beta = np.array([[k + 1.0, 0.5] for k in range(len(pairs))])
    monkeypatch.setattr(logistic, "SCORES_A_TASK", 300)
    scored = logistic.held_out_scores(df, "label", pairs, beta)
    sizes = [r["count"] for r in scored.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 2400 and len(sizes) >= 6 and max(sizes) <= 600
    want = sorted((k, round(a * (k + 1) + 0.5, 9), y) for a, y, f in rows for k, (held, _) in enumerate(pairs) if held == f)
    assert sorted((r["class"], round(r.score, 9), r.hit) for r in scored.collect()) == want


# --- many rows ----------------------------------------------------------------

def coarse_classes(spark, n=2400, seed=12):
    """Classes along numbers with few distinct values and a category, every third row held out."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, g = rng.randint(0, 20), rng.choice("abcdefg")
        rows.append((i, rng.choices((0, 1, 2), (4 + a % 5, 2 + 3 * (g in "bd"), 1 + 2 * (a > 12)))[0], float(a), rng.randint(0, 30) / 7, g, rng.choice((0.5, 1.0, 2.0)), i % 3 == 0))
    return stage(spark.createDataFrame(rows, "i long, y int, a double, b double, g string, weight double, held boolean").repartition(5), "rows")


def test_held_out_rows_stop_the_boosting_of_many_rows_alike(spark, monkeypatch):
    """A validation column does not send many rows to the learner of the library; losses and rounds are the same."""
    df = coarse_classes(spark)
    prepared = Pipeline(stages=models.feature_stages(df, ["a", "b"], ["g"])).fit(df)
    ready, parts = stage(prepared.transform(df), "ready"), models.feature_parts(prepared, ["a", "b"], ["g"])
    monkeypatch.setattr(boosting.histograms, "STORED_EVERY", 2)
    found = []
    for most in (1 << 40, 0):
        monkeypatch.setattr(boosting, "LEARNER_ROWS", most)
        found.append(boosting.fit_softmax(ready, "y", (0, 1, 2), maxIter=9, maxDepth=3, stepSize=1.0, validation="held", patience=2, **parts))
        monkeypatch.setattr(boosting, "RandomForestRegressor", lambda **_: pytest.fail("the library's learner was asked for many rows"))
    assert len(found[0].losses) < 9 and np.allclose(found[0].losses, found[1].losses, atol=1e-9) and found[0].best == found[1].best


def test_trees_of_many_rows_draw_rows_and_features(spark, monkeypatch):
    """The rows of a tree are the same in all its passes: children have the weight of their parent; a node asks few features."""
    from delayworks.operators import histograms

    monkeypatch.setattr(boosting, "LEARNER_ROWS", 0)
    df = stage(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(coarse_classes(spark, 6000)), "rows")
    drawn, real = [], histograms._best
    monkeypatch.setattr(histograms, "_best", lambda table, columns, smallest, marks=None: drawn.append((table[0, 0], marks)) or real(table, columns, smallest, marks))
    whole = boosting.fit_softmax(df, "y", (0, 1, 2), maxIter=1, maxDepth=1)
    mass = [weight for weight, marks in drawn if marks is None]
    drawn.clear()
    fit = boosting.fit_softmax(df, "y", (0, 1, 2), maxIter=2, maxDepth=3, subsamplingRate=0.7, featureSubsetStrategy="0.5")
    assert len(whole.rounds) == 1 and len(mass) == 3 and len(fit.rounds) == 2
    assert all(abs(weight / m - 0.7) < 0.04 for (weight, _), m in zip(drawn[:3], mass)) and len({round(w / m, 9) for (w, _), m in zip(drawn[:3], mass)}) == 3
    assert all(marks.sum() == 1 for _, marks in drawn) and {int(np.argmax(marks)) for _, marks in drawn} == {0, 1}
    for tree in (t for trees in fit.rounds for t in trees):
        root = tree._java_obj.rootNode()
        if root.getClass().getSimpleName() == "InternalNode":
            parts = [root.leftChild().impurityStats().stats()[0], root.rightChild().impurityStats().stats()[0]]
            assert math.isclose(sum(parts), root.impurityStats().stats()[0], rel_tol=1e-9)
    assert [histograms.features_a_node(s, 10) for s in ("all", "1.0", "0.73", "3", "30", "sqrt", "onethird", "log2")] == [10, 10, 8, 3, 10, 4, 4, 4]


def test_the_settings_of_a_fold_share_its_codes(spark, monkeypatch):
    from delayworks.operators import histograms

    monkeypatch.setattr(boosting, "LEARNER_ROWS", 0)
    coded, real = [], histograms.prepare
    monkeypatch.setattr(histograms, "prepare", lambda *a, **k: coded.append(1) or real(*a, **k))
    settings = [{"maxIter": 2, "maxDepth": 2, "subsamplingRate": 0.8}, {"maxIter": 1, "maxDepth": 1}, {"maxIter": 1, "maxDepth": 2, "featureSubsetStrategy": "0.6"}]
    _, trials = models.tune_multiclass(coarse_classes(spark, 600).drop("held"), "y", ["a", "b"], ["g"], ["i"], settings)
    assert len(coded) == models.FOLDS + 1 and {r.trial for r in trials.collect()} == {0, 1, 2}


def test_many_rows_are_read_in_blocks(spark, monkeypatch):
    """A pass reads a record for many rows, not one for each."""
    monkeypatch.setattr(boosting, "LEARNER_ROWS", 0)
    stored, real = {}, boosting.histograms.stage
    monkeypatch.setattr(boosting.histograms, "stage", lambda table, name: stored.setdefault(name, real(table, name)))
    df = coarse_classes(spark, 2400)
    models.fit_multiclass(df, "y", ["a", "b"], ["g"], maxIter=1, maxDepth=1)
    blocks = stored["blocks"]
    assert stored["binned"].count() == 2400 and 75 <= blocks.count() <= 75 + 8
    assert blocks.agg(F.sum(F.octet_length("w")) / 8).first()[0] == blocks.count() * 32


def test_medians_of_many_rows_are_exact(spark, monkeypatch):
    from delayworks.operators import histograms

    rng = random.Random(6)
    rows = [(rng.choice((None, math.nan, float(rng.randint(0, 300)))), float(i % 5), None if i % 2 else i * 0.5) for i in range(5001)]
    df = stage(spark.createDataFrame(rows, "a double, b double, c double").repartition(4), "rows")
    known = [sorted(v for v in column if v is not None and not math.isnan(v)) for column in zip(*rows)]
    want = [v[math.ceil(len(v) / 2) - 1] for v in known]
    assert histograms.medians(df, ["a", "b", "c"]) == want
    monkeypatch.setattr(boosting, "LEARNER_ROWS", 0)
    filled = Pipeline(stages=models.feature_stages(df, ["a", "b", "c"], [])).fit(df).transform(df.where("a is null and c is null").limit(1)).first()
    assert [filled.a_filled, filled.c_filled] == [want[0], want[2]]
    monkeypatch.setattr(histograms, "MEDIAN_POINTS", 50)
    for v, m in zip(known, histograms.medians(df, ["a", "b", "c"])):
        assert abs(np.searchsorted(v, m) / len(v) - 0.5) < 0.2 and m in v


def test_values_are_numbered_from_their_counts(spark):
    """Rows are not read again to number the values of categorical columns."""
    df = stage(spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c d",)], "g string").withColumn("n", F.lit(1.0)), "rows")
    fitted = next(s for s in models.feature_stages(df, ["n"], ["g"]) if s.hasParam("stringOrderType"))
    assert [*map(list, fitted.labelsArray)] == [["a", "b", "c d"]]


def test_the_search_query_learns_from_all_rows(spark, small, monkeypatch):
    from delayworks.plans.catalog import flights, learning

    asked = {}
    monkeypatch.setattr(models, "tune_multiclass", lambda train, label, numeric, text, keys, settings, sample=None, **_: asked.update(rows=train.count(), sample=sample) or (None, train))
    monkeypatch.setattr(prep, "row_cap", lambda *_: pytest.fail("a sample was taken"))
    learning.tune_multiclass(spark, small)
    assert asked == {"rows": flights.gold(spark, small).count(), "sample": None}


def test_training_learns_from_all_of_train(spark, monkeypatch):
    from delayworks.plans import jobs

    rows = [(f"2024-{1 + i % 12:02d}-10", i, i % 3, float(i % 7)) for i in range(240)]
    df = spark.createDataFrame(rows, "FlightDate string, k int, IS_DELAYED int, DISTANCE double")
    monkeypatch.setattr(prep, "row_cap", lambda *_: pytest.fail("a sample was taken"))
    learned, real = [], boosting.fit_softmax
    monkeypatch.setattr(boosting, "fit_softmax", lambda ready, *a, **k: learned.append(ready.count()) or real(ready, *a, **k))
    _, split, report = jobs.training_metrics(df, months=(12, 1, 2), keys=["k"], maxIter=1, maxDepth=1)
    assert learned == [split.where("split = 'train'").count()] and report.where("split = 'test'").count() > 0
