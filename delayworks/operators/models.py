"""Fitting and scoring with Spark ML."""

from __future__ import annotations

import math
import random
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.feature import (
    Imputer, ImputerModel, OneHotEncoder, OneHotEncoderModel, SQLTransformer, StandardScaler, StringIndexer, StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.functions.flights import flag
from delayworks.operators import boosting, histograms, logistic
from delayworks.operators import metrics as mx
from delayworks.operators.dictionaries import DictionaryIndexer, fit_indexer
from delayworks.operators.prep import WIDE_VALUES, fit_modes, modes_of, value_counts  # noqa: F401  (fit_modes is offered here too)
from delayworks.sources.staging import stage
from delayworks.sources.steps import Steps

SEED = 42
FOLDS = 3
CLASSES = mx.CLASSES
# Ranges of the random search over boosted trees.
SEARCH = {
    "maxIter": (300, 600), "stepSize": (0.03, 0.15), "maxDepth": (3, 6),
    "subsamplingRate": (0.7, 0.95), "featureSubsetStrategy": (0.7, 0.95),
}
# Powers of ten of the search over regularisation, and its number of steps.
STRENGTHS, STRENGTH_STEPS = (-2, 2), 20
# Default budgets of the searches.
TREE_TRIALS, LOGREG_TRIALS, LOGREG_ITERATIONS = 20, 20, 500
#: Fits of a search that run side by side.
SIDE_BY_SIDE = 3


class BlendedEvaluator(Evaluator):
    """Half macro one-vs-rest AUC, half macro F1."""

    def __init__(self, label: str):
        super().__init__()
        self.label = label

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = with_probabilities(dataset)
        auc = mx.macro_ranking(mx.ranking_by_class(mx.one_vs_rest(scored, self.label))).select("roc_auc_macro_ovr")
        f1 = mx.classification_report(scored, self.label, "pred_class").select("f1_macro")
        return 0.5 * (auc.first()[0] or 0.0) + 0.5 * (f1.first()[0] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def feature_stages(train: DataFrame, numeric: list[str], categorical: list[str], scale: bool = False) -> list:
    """Median and mode imputation, one-hot encoding that ignores unknown values, assembly, optional scaling.

    The modes of ``train`` are part of the stages: a saved pipeline fills nulls when it scores as it did in training.
    """
    filled, known = [f"{c}_filled" for c in numeric], [f"{c}_known" for c in categorical]
    index, hot = [f"{c}_index" for c in categorical], [f"{c}_hot" for c in categorical]
    stages = [median_filler(train, numeric, filled)]
    if categorical:
        counts = stage(value_counts(train, categorical), "values")
        stages.append(mode_filler(counts, categorical))
        wide = wide_columns(counts, categorical)
        few = [c for c in categorical if c not in wide]
        if few:
            stages.append(indexer(counts, few))
        stages += [fit_indexer(train.withColumnRenamed(c, f"{c}_known"), f"{c}_known", f"{c}_index") for c in wide]
        stages.append(OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True))
    stages.append(VectorAssembler(inputCols=filled + hot, outputCol="assembled" if scale else "features"))
    if scale:
        stages.append(StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True))
    return stages


def wide_columns(counts: DataFrame, categorical: list[str], most: int = WIDE_VALUES) -> list[str]:
    """Columns with too many values for the driver, out of counted values; they are numbered by a stored dictionary."""
    sizes = {r["column"]: r["count"] for r in counts.groupBy("column").count().collect()}  # one row per column
    return [c for c in categorical if sizes.get(c, 0) > most]


def median_filler(train: DataFrame, numeric: list[str], filled: list[str]) -> Imputer | ImputerModel:
    """Median imputation. The library's sketches take longest of all that is fitted: many rows give their medians in Arrow batches."""
    imputer = Imputer(inputCols=numeric, outputCols=filled, strategy="median")
    if train.count() <= boosting.LEARNER_ROWS:
        return imputer
    known = train.sparkSession.createDataFrame([tuple(histograms.medians(train, numeric))], ", ".join(f"`{c}` double" for c in numeric))
    return imputer.fit(known)  # the median of one row is the row


def indexer(counts: DataFrame, columns: list[str]) -> StringIndexerModel:
    """Numbers of the values in their order, out of counted values: the rows are not read again."""
    known = counts.select(*[F.when(F.col("column") == c, F.col("value")).alias(f"{c}_known") for c in columns])
    return StringIndexer(inputCols=known.columns, outputCols=[f"{c}_index" for c in columns], handleInvalid="keep",
                         stringOrderType="alphabetAsc").fit(known)


def mode_filler(counts: DataFrame, categorical: list[str]) -> SQLTransformer:
    """``<c>_known``: the column with its training mode for nulls, as a stage that can be saved."""
    modes = {r["column"]: r["mode"] for r in modes_of(counts).collect()}  # one row per column

    def filled(c: str) -> str:
        text = "NULL" if modes.get(c) is None else "'" + modes[c].replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"coalesce(CAST(`{c}` AS STRING), CAST({text} AS STRING)) AS `{c}_known`"

    return SQLTransformer(statement=f"SELECT *, {', '.join(map(filled, categorical))} FROM __THIS__")


def trained_columns(model: PipelineModel) -> tuple[list[str], list[str]]:
    """Numeric and categorical columns that a fitted pipeline reads."""
    numeric = [c for s in model.stages if s.hasParam("strategy") for c in s.getInputCols()]
    text = [c.removesuffix("_known") for s in model.stages if s.hasParam("stringOrderType") for c in s.getInputCols()]
    text += [s.getInputCol().removesuffix("_known") for s in model.stages if isinstance(s, DictionaryIndexer)]
    return numeric, text


def check_columns(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The frame with its trained numeric columns as numbers; an error that names the trained columns it lacks."""
    numeric, text = trained_columns(model)
    missing = [c for c in (*numeric, *text) if c not in df.columns]
    if missing:
        raise ValueError(f"the model was trained on columns that are missing: {', '.join(missing)}")
    return as_doubles(df, numeric)


def as_doubles(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def with_folds(df: DataFrame, keys: list[str], folds: int = FOLDS) -> DataFrame:
    """Fold number by the hash of a row's key: the same row is always in the same fold."""
    return df.withColumn("fold", F.pmod(F.xxhash64(*keys), F.lit(folds)).cast("int"))


def fit_multiclass(train: DataFrame, label: str, numeric, categorical, sample: DataFrame | None = None, validation: str | None = None,
                   **params) -> PipelineModel:
    """Imputation and encodings fitted on ``train``; the boosted trees on it too, or on a sample of its rows.

    The three classes share one softmax objective. ``validation`` names a boolean column of rows that stop the boosting.
    """
    prepared = Pipeline(stages=feature_stages(train, numeric, categorical)).fit(train)
    ready = prepared.transform(train if sample is None else sample)  # stored as the learner needs it
    boosted = boosting.fit_softmax(ready, label, CLASSES, validation=validation, **feature_parts(prepared, numeric, categorical),
                                   **{"seed": SEED} | params)
    return boosting.boosted_pipeline(prepared.stages, boosted)


def feature_parts(prepared: PipelineModel, numeric, categorical) -> dict:
    """The columns that ``features`` is assembled from, as :func:`boosting.fit_softmax` takes them."""
    sizes = next((s.categorySizes for s in prepared.stages if isinstance(s, OneHotEncoderModel)), [])
    return {"numeric": [f"{c}_filled" for c in numeric], "categories": [(f"{c}_index", n - 1) for c, n in zip(categorical, sizes)]}


def random_settings(trials: int, ranges=None, seed: int = SEED) -> list[dict]:
    """Settings drawn from the search ranges; the step size on a logarithmic scale."""
    rng, ranges = random.Random(seed), SEARCH | (ranges or {})
    drawn = []
    for _ in range(trials):
        low, high = ranges["stepSize"]
        drawn.append({
            "maxIter": rng.randint(*ranges["maxIter"]),
            "stepSize": math.exp(rng.uniform(math.log(low), math.log(high))),
            "maxDepth": rng.randint(*ranges["maxDepth"]),
            "subsamplingRate": rng.uniform(*ranges["subsamplingRate"]),
            "featureSubsetStrategy": str(rng.uniform(*ranges["featureSubsetStrategy"])),
        })
    return drawn


def tune_multiclass(train: DataFrame, label: str, numeric, categorical, keys, settings: list[dict], sample: DataFrame | None = None,
                    patience: int = boosting.PATIENCE, steps: Steps | None = None):
    """Search over settings with three hash folds and the blended objective, on ``train`` or a sample of its rows.

    The held-out fold stops the boosting of the others. Returns the model refitted with the best setting, for as many
    rounds as its folds took on average, and one row per setting and parameter. With ``steps`` the prepared rows, every
    trial of a fold and the model are stored as they come, and a run that was stopped goes on from there.
    """
    steps = steps or Steps()
    prepared = steps.model("preparation", lambda: Pipeline(stages=feature_stages(train, numeric, categorical)).fit(train))
    objective, parts = BlendedEvaluator(label), feature_parts(prepared, numeric, categorical)
    used = [label, "weight", "features", *parts["numeric"], *[c for c, _ in parts["categories"]], "fold"]
    ready = steps.table("folds", lambda: with_folds(prepared.transform(train if sample is None else sample), keys).select(*used))
    shared = [boosting.Once() for _ in range(FOLDS)]  # the settings of a fold code its rows once

    def tried(task: tuple[int, int]) -> tuple[float, int]:
        trial, fold = task
        fit = boosting.fit_softmax(ready.withColumn("held", F.col("fold") == fold), label, CLASSES, validation="held", patience=patience,
                                   shared=shared[fold], **parts, **{"seed": SEED} | settings[trial])
        scored = boosting.boosted_pipeline([], fit).transform(ready.where(F.col("fold") == fold))
        return objective.evaluate(stage(scored.select(label, *mx.PROBABILITIES), "held")), fit.best

    def remembered(task: tuple[int, int]) -> list:
        return steps.value(f"trial-{task[0]}-fold-{task[1]}", lambda: list(tried(task)))

    tasks = [(trial, fold) for trial in range(len(settings)) for fold in range(FOLDS)]
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        found = dict(zip(tasks, pool.map(remembered, tasks)))
    scores = [sum(found[trial, fold][0] for fold in range(FOLDS)) / FOLDS for trial in range(len(settings))]
    best = max(range(len(settings)), key=scores.__getitem__)
    rounds = max(1, round(sum(found[best, fold][1] for fold in range(FOLDS)) / FOLDS))

    def refitted() -> PipelineModel:
        boosted = boosting.fit_softmax(ready, label, CLASSES, **parts, **{"seed": SEED} | settings[best] | {"maxIter": rounds})
        return boosting.boosted_pipeline(prepared.stages, boosted)

    return steps.model("model", refitted), search_rows(train.sparkSession, scores, settings)


def search_rows(spark, scores: list[float], settings: list[dict]) -> DataFrame:
    best = max(scores)
    rows = [(i, name, str(value), float(score), bool(score == best))
            for i, (setting, score) in enumerate(zip(settings, scores)) for name, value in setting.items()]
    return spark.createDataFrame(rows, "trial int, param string, param_value string, objective double, best boolean")


def tune_logreg(train: DataFrame, label: str, numeric, categorical, keys, trials: int = LOGREG_TRIALS,
                iterations: int = LOGREG_ITERATIONS):
    """Random search over the strength of a weighted, L2-regularised logistic regression, by AUC."""
    low, high = STRENGTHS
    steps = random.Random(SEED).sample(range(STRENGTH_STEPS), trials)
    strengths = [10 ** (low + (high - low) * i / (STRENGTH_STEPS - 1)) for i in sorted(steps)]
    # The library adds the penalty to the mean loss, so an inverse strength C is 1 / (C n).
    n = train.count()
    settings = [{"regParam": 1.0 / (c * n)} for c in strengths]
    prepared = Pipeline(stages=feature_stages(train, numeric, categorical, scale=True)).fit(train)
    regression = LogisticRegression(labelCol=label, featuresCol="features", weightCol="weight", elasticNetParam=0.0,
                                    standardization=False, maxIter=iterations)
    folds = stage(with_folds(prepared.transform(train), keys), "folds")
    scores = logreg_scores(folds, label, [s["regParam"] for s in settings], regression)
    best = max(range(len(settings)), key=scores.__getitem__)
    model = PipelineModel(stages=[*prepared.stages, regression.copy({regression.regParam: settings[best]["regParam"]}).fit(folds)])
    return model, search_rows(train.sparkSession, scores, settings)


def logreg_scores(folds: DataFrame, label: str, penalties: list[float], regression: LogisticRegression) -> list[float]:
    """Mean AUC of each penalty over the held-out folds.

    All penalties and folds are fitted by the same passes over the rows; a table with more features than that holds is
    searched one penalty and fold at a time.
    """
    attributes = folds.schema["features"].metadata.get("ml_attr", {})
    if int(attributes.get("num_attrs", sum(len(g) for g in attributes.get("attrs", {}).values()))) > logistic.MOST_FEATURES:
        search = CrossValidator(
            estimator=regression, estimatorParamMaps=[{regression.regParam: p} for p in penalties], numFolds=FOLDS, foldCol="fold",
            evaluator=BinaryClassificationEvaluator(labelCol=label), seed=SEED, parallelism=4)
        return search.fit(folds).avgMetrics
    pairs = [(fold, p) for p in penalties for fold in range(FOLDS)]
    beta, _ = logistic.fit_path(folds, label, pairs)
    counts = logistic.held_out_scores(folds, label, pairs, beta).groupBy("class", "score").agg(
        F.sum(F.col("hit").cast("bigint")).alias("pos"), F.sum((1 - F.col("hit")).cast("bigint")).alias("neg"))
    auc = {r["class"]: r["auc"] for r in mx.ranking_by_class(counts).select("class", "auc").collect()}  # a row per pair
    return [sum(auc.get(FOLDS * i + fold) or 0.0 for fold in range(FOLDS)) / FOLDS for i in range(len(penalties))]


def fit_binary(train: DataFrame, label: str, numeric, categorical, **params) -> PipelineModel:
    """Boosted trees for two classes."""
    settings = {"maxIter": 10, "maxDepth": 4, "seed": SEED} | params
    trees = GBTClassifier(labelCol=label, featuresCol="features", **settings)
    return Pipeline(stages=[*feature_stages(train, numeric, categorical), trees]).fit(train)


def tune_binary(train: DataFrame, label: str, numeric, categorical, keys, settings: list[dict]):
    """Search over settings of the two-class booster with three hash folds, by AUC.

    Returns the model refitted with the best setting and one row per setting and parameter.
    """
    prepared = Pipeline(stages=feature_stages(train, numeric, categorical)).fit(train)
    trees = GBTClassifier(labelCol=label, featuresCol="features", seed=SEED)
    grid = [{getattr(trees, name): value for name, value in setting.items()} for setting in settings]
    search = CrossValidator(estimator=trees, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol=label),
                            numFolds=FOLDS, foldCol="fold", seed=SEED, parallelism=4)
    found = search.fit(stage(with_folds(prepared.transform(train), keys), "folds"))
    return PipelineModel(stages=[*prepared.stages, found.bestModel]), search_rows(train.sparkSession, found.avgMetrics, settings)


def with_probabilities(scored: DataFrame) -> DataFrame:
    """The most probable class of a frame that holds the probability of each."""
    return scored.withColumn("pred_class", mx.argmax_class())


def with_default_probability(scored: DataFrame) -> DataFrame:
    """Probability of the positive class of a two-class model."""
    return scored.withColumn("default_proba", F.get(vector_to_array("probability"), F.lit(1)))


def score_multiclass(model: PipelineModel, df: DataFrame, keys: list[str], label: str | None = None) -> DataFrame:
    """Prediction rows: class, probabilities, keys carried through, time of scoring."""
    scored = with_probabilities(model.transform(df))
    known = [label] if label and label in df.columns else []
    return scored.select("pred_class", *mx.PROBABILITIES, *keys, F.current_timestamp().alias("predicted_at"), *known)


def score_threshold(df: DataFrame, score: str, threshold: float = 0.5) -> DataFrame:
    return df.withColumn("default", flag(F.col(score) >= threshold))


def feature_importance(model: PipelineModel, scored: DataFrame) -> DataFrame:
    """Importance of each source column, averaged over the boosters, largest first: the parts of an encoded column are summed.

    Shares of 1; all zero only if no tree of the model has a split.
    """
    attributes = scored.schema["features"].metadata["ml_attr"]["attrs"]
    numeric, text = trained_columns(model)
    source = {a["idx"]: column_of(a["name"], numeric, text) for group in attributes.values() for a in group}
    boosters = [s.featureImportances for s in model.stages if hasattr(s, "featureImportances")]
    total = dict.fromkeys((*numeric, *text), 0.0)
    for weights in boosters:
        for i, w in zip(weights.indices.tolist(), weights.values.tolist()):
            total[source[i]] += w
    whole = sum(total.values()) or 1.0
    rows = [(c, w / whole) for c, w in total.items()]
    return scored.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def column_of(part: str, numeric: list[str], text: list[str]) -> str:
    """The source column of a feature: the column itself, or the encoded one whose value the feature stands for."""
    if part.removesuffix("_filled") in numeric:
        return part.removesuffix("_filled")
    return max((c for c in text if re.match(re.escape(f"{c}_hot_"), part)), key=len)


def evaluate_binary(scored: DataFrame, label: str, score: str = "default_proba", threshold: float = 0.5) -> DataFrame:
    """AUC, Gini and the threshold metrics of a binary model as (metric, value) rows."""
    ranked = mx.ranking_by_class(mx.binary_scores(scored, label, score))
    ranking = ranked.select(F.col("auc"), mx.gini(F.col("auc")).alias("gini"))
    called = scored.withColumn("_called", flag(F.col(score) >= threshold))
    return mx.melt(ranking).unionByName(mx.melt(mx.classification_report(called, label, "_called")))


def evaluate_multiclass(scored: DataFrame, label: str, fixed_classes: bool = True) -> DataFrame:
    """All training metrics as (metric, value) rows."""
    parts = [
        mx.macro_ranking(mx.ranking_by_class(mx.one_vs_rest(scored, label)), fixed_classes),
        mx.classification_report(scored, label, "pred_class").select(
            "accuracy", "precision_macro", "precision_weighted", "recall_macro", "recall_weighted", "f1_macro", "f1_weighted"),
        mx.quadratic_kappa(scored, label, "pred_class"),
    ]
    rows = [mx.melt(p) for p in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])
