"""The batch jobs. Pure functions build a layer; ``run_*`` functions store it."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayworks.operators import airports, cleaning, drift, features, joins, loans, models, prep, runs, validate, weather
from delayworks.operators import metrics as mx
from delayworks.sources import readers, schemas, sinks
from delayworks.sources.staging import stage
from delayworks.sources.steps import Steps

BRONZE_ORDER = ["sort_time", "OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM"]
SILVER_ORDER = ["FlightDate", *BRONZE_ORDER]
BY_DEFAULT = object()  # the validator that fits the run
WEATHER_END, CUTOFF = "2025-04-01", "2025-01-01"  # Fixed values: last observation day, first daily slice.


# --- layers -----------------------------------------------------------------

def bronze_flights(raw: DataFrame, day=None) -> DataFrame:
    """Metro flights with derived columns; ``day`` gives the daily slice with its snapshot date."""
    df = raw.transform(cleaning.load_filter, day).transform(cleaning.add_derived)
    return df.withColumn("snapshot_date", F.lit(day).cast("date")) if day else df


def silver_flights(bronze: DataFrame) -> DataFrame:
    """One clean, typed row per flown flight."""
    return (
        bronze.transform(cleaning.dedupe_flights).transform(cleaning.enforce_types)
        .transform(cleaning.drop_cancelled).transform(cleaning.drop_cancelled_with_delay)
        .transform(cleaning.drop_outliers)
    )


def gold_flights(silver: DataFrame, day=None, history: DataFrame | None = None) -> DataFrame:
    """Flight features, laid out by snapshot date."""
    df = readers.snapshot_backfill(silver, day)
    if day:
        df = readers.snapshot_slice(df, day)
    return features.flight_features(df, history)


def gold_combined(gold: DataFrame, silver_weather: DataFrame, day=None, **options) -> DataFrame:
    """Flight features with the weather at their metro end; ``day`` reads one slice of each stored table."""
    if day is None:
        return joins.join_weather(gold, silver_weather, **options)
    flights = readers.snapshot_slice(gold, day)
    slots = silver_weather.where(F.col("date") == F.lit(day).cast("date"))
    if "slice" in silver_weather.columns:  # stored weather is laid out by slice
        slots = slots.where(F.col("slice").isin("history", F.lit(day).cast("date").cast("string")))
    return joins.join_weather(flights, slots, daily=True, **options).drop("FlightDate")


def training_rows(gold: DataFrame, label: str, date_col: str, months, keys: list[str], steps: Steps | None = None):
    """Usable rows, downsampled and split by month: the split table and its numeric and text features.

    ``gold`` is read once; keys, date, label and features are stored, the other columns are not read again.
    """
    steps = steps or Steps()
    kept = cleaning.coerce_dates(gold, date_col, label)[0]
    numeric, text = prep.feature_columns(kept, exclude=(label, date_col, "leg", "TAIL_NUM", "year_month", "slice"))
    used = {*keys, date_col, label, *numeric, *text}
    usable = steps.table("usable", lambda: kept.select(*[c for c in kept.columns if c in used]))
    sampled = steps.table("sampled", lambda: prep.downsample_majority(usable, keys, label))  # its last month is asked for
    split = steps.table("split", lambda: models.as_doubles(prep.time_split(sampled, date_col, *months), numeric))
    return split, numeric, text


def training_metrics(gold: DataFrame, label: str = "IS_DELAYED", date_col: str = "FlightDate",
                     months=(24, 1, 1), keys=(*cleaning.FLIGHT_KEY,), cap: int | None = None,
                     settings: list[dict] | None = None, steps: Steps | None = None, **params):
    """Split, downsample, weight, fit on train, and evaluate on validation and test.

    Medians, modes, encodings, class weights and trees come from all of train; only a caller that gives a ``cap`` has its
    trees fitted on so many rows. With ``settings`` the best of them is searched and refitted, else ``params`` are fitted.
    Returns the model, the split table and (split, metric, value) rows; with a search also its trials. ``steps`` stores
    what is done, so that a run that was stopped goes on from its last step.
    """
    keys, steps = list(keys), steps or Steps()
    split, numeric, text = training_rows(gold, label, date_col, months, keys, steps)
    train = steps.table("train", lambda: prep.class_weights(split.where("split = 'train'"), label))
    sample = None if cap is None else steps.table("sample", lambda: prep.row_cap(train, keys, cap))
    trials = None
    if settings:
        model, trials = models.tune_multiclass(train, label, numeric, text, keys, settings, sample, steps=steps)
    else:
        model = steps.model("model", lambda: models.fit_multiclass(train, label, numeric, text, sample, **params))
    reports = []
    for name in ("val", "test"):
        scored = steps.table(f"scored-{name}", lambda: models.score_multiclass(model, split.where(F.col("split") == name), keys, label))
        reports.append(models.evaluate_multiclass(scored, label).select(F.lit(name).alias("split"), "metric", "value"))
    report = reports[0].unionByName(reports[1])
    return (model, split, report, trials) if settings else (model, split, report)


def credit_training(feature_table: DataFrame, labels: DataFrame, train_date, train_test_months: int, oot_months: int,
                    numeric: list[str], categorical: list[str], key: str, ratio: float = 0.8, trials: int = models.LOGREG_TRIALS,
                    iterations: int = models.LOGREG_ITERATIONS):
    """Labelled customer features, split around a training date; tuned regression; metrics per split.

    Returns the model, the trials of its search and (split, metric, value) rows for train, test and out-of-time.
    """
    rows = joins.features_with_labels(feature_table, labels).where("label is not null")
    typed = rows.withColumns({c: F.col(c).try_cast("double") for c in (*numeric, "label")})
    split = stage(prep.oot_split(typed, "label_snapshot_date", train_date, train_test_months, oot_months), "windows")
    parts = prep.stratified_split(split.where("split = 'train_test'").drop("split"), [key], "label", ratio)
    every = stage(parts.unionByName(split.where("split = 'oot'")), "splits")
    weighted = stage(prep.class_weights(every.where("split = 'train'"), "label"), "train")
    model, search = models.tune_logreg(weighted, "label", numeric, categorical, [key], trials, iterations)
    scored = stage(models.with_default_probability(model.transform(every)).select("split", "label", "default_proba"), "scored")
    report = None
    for name in ("train", "test", "oot"):
        part = models.evaluate_binary(scored.where(F.col("split") == name), "label")
        part = part.select(F.lit(name).alias("split"), "metric", "value")
        report = part if report is None else report.unionByName(part)
    return model, search, report


def credit_scores(model, feature_table: DataFrame, day, threshold: float = 0.5) -> DataFrame:
    """Default probability and flag of the customers of one label day."""
    rows = readers.snapshot_slice(feature_table, day, "label_snapshot_date")
    numeric, _ = models.trained_columns(model)
    typed = models.check_columns(model, rows.withColumns({c: F.col(c).try_cast("double") for c in numeric if c in rows.columns}))
    scored = models.with_default_probability(model.transform(typed))
    flagged = models.score_threshold(scored, "default_proba", threshold)
    return flagged.select("Customer_ID", "label_snapshot_date", "default_proba", "default",
                          F.lit(day).cast("date").alias("snapshot_date"), F.current_timestamp().alias("scored_at"))


def monitor_report(predictions: DataFrame, day, label: str = "IS_DELAYED") -> DataFrame:
    """Quality and drift of one day's predictions as (metric, value) rows."""
    today = stage(predictions.where(F.col("snapshot_date") == F.lit(day).cast("date")), "today")
    parts = [
        mx.melt(mx.macro_ranking(mx.ranking_by_class(mx.one_vs_rest(today, label))), "perf_"),
        mx.melt(mx.classification_report(today, label, "pred_class").select(
            "accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted"), "perf_"),
        mx.melt(mx.quadratic_kappa(today, label, "pred_class"), "perf_"),
        mx.melt(drift.drift_report(predictions, day)),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.where("value is not null")


def monthly_monitor(run_table: DataFrame, scores: DataFrame, labels: DataFrame, month, load_order: str,
                    threshold: float = 0.5) -> DataFrame:
    """Binary metrics and score summary of the newest scoring run of a month, as (metric, value) rows."""
    predicted = stage(runs.latest_run_for_month(run_table, scores, month), "scores")
    known = runs.monthly_labels(labels, month, load_order)
    joined = stage(joins.predictions_with_labels(predicted, known), "joined")
    quality = mx.binary_metrics(joined, "label", "default_proba", threshold).where("tp + tn + fp + fn > 0")
    quality = quality.withColumn("gini", mx.gini(F.col("auc_roc")))
    summary = mx.score_summary(predicted, "default_proba")
    return mx.melt(quality).unionByName(mx.melt(summary))


# --- stored runs --------------------------------------------------------------
# Every run of a layer checks what it stored: ``check`` is a validator of operators/validate.py, called on the rows of the
# run with strict=True, so that a failed check stops it; ``check=None`` leaves it out.

def _checked(spark: SparkSession, out: str, check, day=None) -> None:
    if check is not None:
        stored = spark.read.parquet(out)
        check(readers.snapshot_slice(stored, day) if day else stored, strict=True)


def bronze_check(start=None, end=None, day=None):
    """Validator of the days that a bronze run stores; other months of the table are not looked at."""
    first = F.lit(day).cast("date") if day else F.make_date(F.lit(start[0]), F.lit(start[1]), F.lit(1))
    last = F.lit(day).cast("date") if day else F.last_day(F.make_date(F.lit(end[0]), F.lit(end[1]), F.lit(1)))

    def check(stored: DataFrame, strict: bool = False) -> DataFrame:
        return validate.validate_bronze(stored.where(F.col("FlightDate").between(first, last)), 1, 1 << 62, first, last, strict=strict)

    return check


def combined_check(gold: DataFrame, day=None, min_coverage: float = validate.LEAST_COVERAGE):
    """Validator of a combined run: as many rows as the flights have metro ends, weather for most of them."""
    flights = readers.snapshot_slice(gold, day) if day else gold

    def check(stored: DataFrame, strict: bool = False) -> DataFrame:
        return validate.validate_combined(stored, joins.explode_legs(flights).count(), bool(day), min_coverage, strict)

    return check


def _store(df: DataFrame, out: str, by: str, order: list[str], append: bool) -> None:
    """Replace the partitions at hand, or append the rows they lack."""
    if append:
        sinks.append_new_rows(df, out, by, ignore=("processing_timestamp",))
    else:
        sinks.write_partitioned(df, out, by, order)


def run_bronze_flights(spark: SparkSession, folder: str, out: str, start=None, end=None, day=None,
                       schema=schemas.RAW_FLIGHT_TYPES, append: bool = False, check=BY_DEFAULT) -> None:
    """Monthly files to the bronze table, by month, or one day to its daily slice."""
    raw = readers.read_day(spark, folder, day, schema) if day else readers.read_months(spark, folder, start, end, schema)
    _store(bronze_flights(raw, day), out, "snapshot_date" if day else "year_month", ["FlightDate", *BRONZE_ORDER], append)
    _checked(spark, out, bronze_check(start, end, day) if check is BY_DEFAULT else check, day)


def run_silver_flights(spark: SparkSession, bronze: str, out: str, by: str = "year_month", day=None, months=None,
                       append: bool = False, check=validate.validate_silver) -> None:
    """Bronze to silver. ``day`` or ``months`` ('YYYY-MM' keys) read and replace those partitions only."""
    df = spark.read.parquet(bronze)
    df = readers.snapshot_slice(df, day) if day else df
    df = df.where(F.col("year_month").isin(*months)) if months else df
    _store(silver_flights(df), out, by, SILVER_ORDER, append)
    _checked(spark, out, check, day)


def run_gold_flights(spark: SparkSession, silver: str, out: str, day=None, history: str | None = None,
                     check=validate.validate_gold) -> None:
    past = spark.read.parquet(history) if history else None
    sinks.write_partitioned(gold_flights(spark.read.parquet(silver), day, past), out, "snapshot_date", BRONZE_ORDER[1:])
    _checked(spark, out, check, day)


def run_bronze_weather(spark: SparkSession, folder: str, out: str, end=WEATHER_END, cutoff=CUTOFF) -> None:
    raw = readers.read_csv(spark, folder, {}, recursive=True)  # all text: dates are parsed once, at silver
    sinks.write_cutoff_split(weather.bronze_weather(raw, end), out, "extracted_date", cutoff, ["NAME", "DATE"])


def run_silver_weather(spark: SparkSession, bronze: str, out: str, cutoff=CUTOFF) -> None:
    silver = weather.silver_weather(spark.read.parquet(bronze))
    sinks.write_cutoff_split(silver, out, "date", cutoff, ["T+1_forecast", "time"])


def run_gold_combined(spark: SparkSession, gold: str, silver_weather: str, out: str, day=None, check=BY_DEFAULT) -> None:
    flights = spark.read.parquet(gold)
    df = gold_combined(flights, spark.read.parquet(silver_weather), day)
    sinks.write_partitioned(df, out, "snapshot_date", BRONZE_ORDER[1:])
    _checked(spark, out, combined_check(flights, day) if check is BY_DEFAULT else check, day)


def run_training(spark: SparkSession, combined: str, out: str, train_date=None, daily: str | None = None, months=(24, 1, 1),
                 keys=(*cleaning.FLIGHT_KEY,), trials: int = models.TREE_TRIALS, ranges=None, cap: int | None = None) -> None:
    """Stitch history and daily slices, split, search, refit, evaluate; store model, metrics, trials and split summary.

    ``train_date`` limits the rows to the window of ``months`` before it. The search draws ``trials`` settings. Steps
    are stored under ``out/steps``: the same call after a stop goes on from the last of them, other inputs start anew.
    """
    gold = spark.read.parquet(combined)
    if daily or train_date:
        later = spark.read.parquet(daily) if daily else gold.where("false")
        gold = readers.stitch(gold, later, train_date or F.current_date(), months[0])
    settings = models.random_settings(trials, ranges)
    given = {"files": sorted(gold.inputFiles()), "train_date": str(train_date), "months": list(months), "keys": list(keys), "cap": cap, "settings": settings}
    steps = Steps(spark, f"{out}/steps", given)
    model, split, report, found = training_metrics(gold, months=months, keys=keys, cap=cap, settings=settings, steps=steps)
    model.write().overwrite().save(f"{out}/model")
    sinks.write_table(report, f"{out}/metrics")
    sinks.write_table(found, f"{out}/trials")
    sinks.write_table(prep.split_summary(split, "FlightDate", "IS_DELAYED"), f"{out}/splits")


def run_credit_training(spark: SparkSession, feature_table: str, labels: str, out: str, train_date, train_test_months: int,
                        oot_months: int, numeric: list[str], categorical: list[str], key: str, **options) -> None:
    """Tuned regression around a training date; stores model, trials and metrics."""
    model, search, report = credit_training(spark.read.parquet(feature_table), spark.read.parquet(labels), train_date,
                                            train_test_months, oot_months, numeric, categorical, key, **options)
    model.write().overwrite().save(f"{out}/model")
    sinks.write_table(search, f"{out}/trials")
    sinks.write_table(report, f"{out}/metrics")


def run_credit_score(spark: SparkSession, model: str, feature_table: str, out: str, day, threshold: float = 0.5) -> None:
    """Score the customers of one label day with a stored model and replace that day's scores."""
    scores = credit_scores(PipelineModel.load(model), spark.read.parquet(feature_table), day, threshold)
    sinks.write_partitioned(scores, out, "snapshot_date", ["Customer_ID"])


def run_monthly_monitor(spark: SparkSession, run_table: str, scores: str, labels: str, out: str, month, load_order: str,
                        threshold: float = 0.5) -> None:
    """Metrics of the month's newest scoring run; other months stay."""
    report = monthly_monitor(spark.read.parquet(run_table), spark.read.parquet(scores), spark.read.parquet(labels), month, load_order, threshold)
    sinks.write_metrics(report.withColumn("period", F.trunc(F.lit(month).cast("date"), "MM")), out)


def run_ingest_reference(spark: SparkSession, path: str, out: str, schema, table: str | None = None,
                         by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Reference CSV to a raw table named after its file."""
    df = sinks.with_lineage(readers.read_csv(spark, path, schema))
    writer = df.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(f"{out}/{table or readers.table_name_of(path)}")


def run_airports(spark: SparkSession, bronze: str, out: str, codes=None, **options) -> None:
    """Airport dimension, and the subset of the listed airports."""
    raw = spark.read.parquet(f"{bronze}/airports")
    wide = airports.airport_dimension(raw, spark.read.parquet(f"{bronze}/airport_frequencies"), **options)
    sinks.write_table(wide, f"{out}/US_airports")
    if codes:
        stored = spark.read.parquet(f"{out}/US_airports")
        sinks.write_table(airports.airport_subset(stored, raw, codes), f"{out}/new_york")


def run_loans(spark: SparkSession, path: str, out: str) -> None:
    silver = loans.loan_silver(readers.read_csv(spark, path, {}))
    sinks.write_partitioned(silver, out, "snapshot_date", ["loan_id"])


def run_daily_score(spark: SparkSession, model: PipelineModel | str, combined: str, out: str, day, csv_path: str | None = None) -> None:
    """Score one day with a model or the path of a stored one, and replace that day's predictions.

    The trained columns must all be there; the keys and the label are carried through.
    """
    model = PipelineModel.load(model) if isinstance(model, str) else model
    df = models.check_columns(model, readers.snapshot_slice(spark.read.parquet(combined), day))
    predictions = models.score_multiclass(model, df, ["snapshot_date", "flight_id"], "IS_DELAYED")
    sinks.write_predictions(predictions, out, csv_path)


def run_daily_monitor(spark: SparkSession, predictions: str, out: str, day, label: str = "IS_DELAYED") -> None:
    """Metrics of one day with the cells of its confusion matrix (``cm_<actual>_<predicted>``); other days stay."""
    stored = spark.read.parquet(predictions)
    cells = mx.confusion_matrix(readers.snapshot_slice(stored, day), label, "pred_class").select(
        F.concat(F.lit("cm_"), "actual", F.lit("_"), "predicted").alias("metric"), F.col("n").cast("double").alias("value"))
    report = monitor_report(stored, day, label).select("metric", "value").unionByName(cells)
    sinks.write_metrics(report.withColumn("period", F.lit(day).cast("date")), out)
