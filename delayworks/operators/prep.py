"""Splits, sampling, weights and encodings for training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delayworks.functions.flights import month_floor
from delayworks.operators.joins import lookup_join
from delayworks.operators.profile import numeric_columns
from delayworks.operators.ranking import SLICE_ROWS, bounded_sample, hash_select, long_values, numbered, quantiles
from delayworks.sources.staging import stage

# Columns never used as features.
ID_LIKE = ("flight_id", "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "IsPublicHoliday", "is_extra_candidate")
LEAKAGE = (
    "DEP_DELAY_NEW", "DEP_DELAY_GROUP", "ARR_DELAY_NEW", "ARR_DELAY_GROUP", "DEP_TIME", "ARR_TIME",
    "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
    "weather_ceiling_code", "weather_visibility_var_code_idx", "weather_wind_dir_deg", "weather_visibility_var_code",
)
MAJORITY_SHARE = 0.2
#: Rows of a tuning sample, for callers that ask for one; nothing takes a sample by itself.
TUNING_ROWS = 50_000
#: Most values of a categorical column that become columns of their own, or that a fitted stage holds.
WIDE_VALUES = 10_000


def time_split(df: DataFrame, date_col: str, total_months: int, val_months: int, test_months: int) -> DataFrame:
    """Add ``split``: test is the last months, validation the ones before, train the rest of the window."""
    month = month_floor(date_col)
    last = df.agg(F.max(month)).scalar()
    test_start = F.add_months(last, 1 - test_months)
    val_start = F.add_months(last, 1 - test_months - val_months)
    window_start = F.add_months(last, 1 - total_months)
    split = F.when(month >= test_start, "test").when(month >= val_start, "val").otherwise("train")
    return df.where(month >= window_start).withColumn("split", split)


def oot_split(df: DataFrame, date_col: str, train_date, train_test_months: int, oot_months: int) -> DataFrame:
    """Add ``split`` around a training date: out-of-time is the months before it, train/test the ones before those."""
    end = F.lit(train_date).cast("date")
    oot_start = F.add_months(end, -oot_months)
    start = F.add_months(oot_start, -train_test_months)
    day = F.col(date_col)
    kept = df.where((day >= start) & (day < end))
    return kept.withColumn("split", F.when(day >= oot_start, "oot").otherwise("train_test"))


def split_summary(df: DataFrame, date_col: str, label: str) -> DataFrame:
    """Rows, rows per class and first and last month of each split."""
    classes = [F.count_if(F.col(label) == k).alias(f"class_{k}") for k in (0, 1, 2)]
    return df.groupBy("split").agg(
        F.count("*").alias("n_rows"), *classes,
        F.min(month_floor(date_col)).alias("first_month"), F.max(month_floor(date_col)).alias("last_month"))


def stratified_split(df: DataFrame, keys: list[str], label: str, train_ratio: float = 0.8) -> DataFrame:
    """Add ``split``: exactly ``train_ratio`` of each class, rounded down, is train."""
    marked = hash_select(df, keys, [label], fraction=train_ratio)
    return marked.withColumn("split", F.when(F.col("selected"), "train").otherwise("test")).drop("selected")


def downsample_majority(df: DataFrame, keys: list[str], label: str, share: float = MAJORITY_SHARE) -> DataFrame:
    """Keep a share of class 0, rounded down, and every row of the other classes."""
    marked = hash_select(df, keys, [label], fraction=share)
    return marked.where(F.col("selected") | (F.col(label) != 0)).drop("selected")


def row_cap(df: DataFrame, keys: list[str], limit: int = TUNING_ROWS) -> DataFrame:
    """At most ``limit`` rows, the first in hash order (a tuning sample)."""
    return bounded_sample(df, keys, limit)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("class_rows"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Add ``weight``: inverse class frequency, with a mean of 1."""
    counts = stage(class_counts(df, label), "classes")  # rows that are read again are not counted again
    whole = Window.partitionBy(F.lit(0))  # one row per class
    weight = F.sum("class_rows").over(whole) / (F.count("*").over(whole) * F.col("class_rows"))
    # Sent to the rows: a join by shuffle would put all rows of a class into one task.
    return lookup_join(df, F.broadcast(counts.select(label, weight.alias("weight"))), [label], "inner")


def fit_medians(train: DataFrame, columns) -> DataFrame:
    return quantiles(long_values(train, list(columns)), [0.5], ["column"]).select("column", F.col("quantile").alias("median"))


def value_counts(train: DataFrame, columns) -> DataFrame:
    """``(column, value, n)`` of the values that categorical columns have."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return train.select(F.inline(pairs)).where("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))


def modes_of(counts: DataFrame) -> DataFrame:
    """Most frequent value per column out of counted values; equal counts in order of the value."""
    return counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))


def fit_modes(train: DataFrame, columns) -> DataFrame:
    """Most frequent value per categorical column; equal counts in order of the value."""
    return modes_of(value_counts(train, columns))


def fill_from(df: DataFrame, fitted: dict) -> DataFrame:
    """Replace nulls by fitted values, one per column."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(kinds[c])) for c, v in fitted.items() if v is not None})


def impute_median(df: DataFrame, train: DataFrame, columns) -> DataFrame:
    """Numeric nulls replaced by the training median (as double)."""
    medians = {r["column"]: r["median"] for r in fit_medians(train, columns).collect()}  # one row per column
    return fill_from(df.withColumns({c: F.col(c).cast("double") for c in columns}), medians)


def impute_mode(df: DataFrame, train: DataFrame, columns) -> DataFrame:
    """Categorical nulls replaced by the most frequent training value."""
    return fill_from(df, {r["column"]: r["mode"] for r in fit_modes(train, columns).collect()})  # one row per column


def fit_categories(train: DataFrame, column: str, most: int = WIDE_VALUES) -> list:
    """Training values of a categorical column with at most ``most`` of them."""
    values = train.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} values: use fit_dictionary and one_hot_sparse")
    return sorted(r[0] for r in values)


def one_hot(df: DataFrame, train: DataFrame, column: str, most: int = WIDE_VALUES) -> DataFrame:
    """A 0/1 column per training value; an unknown or missing value gives all zeros.

    Made for columns with few values: each becomes a column, in one projection. :func:`one_hot_sparse` takes any number.
    """
    values = fit_categories(train, column, most)
    return df.select("*", *[F.when(F.col(column) == v, 1).otherwise(0).cast("int").alias(f"{column}_{v}") for v in values])


def fit_dictionary(train: DataFrame, column: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``(value, index)`` for every training value of a column, numbered from 0 in the order of the values.

    The values stay distributed: they are numbered by counted range slices, whatever their number.
    """
    values = train.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct()
    return numbered(values, ["value"], "index", slice_rows)


def index_by(df: DataFrame, dictionary: DataFrame, column: str, name: str) -> DataFrame:
    """Add the number of a column's value in its dictionary; null for an unknown or missing value."""
    lookup = dictionary.select(F.col("value").alias("_value"), F.col("index").alias("_index"))
    joined = df.join(lookup, F.col(f"`{column}`").cast("string") == F.col("_value"), "left")
    return joined.withColumn(name, F.col("_index")).drop("_value", "_index")


def one_hot_sparse(df: DataFrame, dictionary: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_hot``: the one-hot vector of a value as its size, indices and values; an unknown one has no index."""
    size = dictionary.count()
    name = f"_{column}_number"
    rows = index_by(df, dictionary, column, name)
    known = F.col(name).isNotNull()
    hot = F.struct(F.lit(size).cast("long").alias("size"),
                   F.when(known, F.array(name)).otherwise(F.array().cast("array<bigint>")).alias("indices"),
                   F.when(known, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"))
    return rows.withColumn(f"{column}_hot", hot).drop(name)


def standard_scale(df: DataFrame, train: DataFrame, columns) -> DataFrame:
    """Add ``<c>_scaled``: centred on the training mean, divided by the training deviation (population)."""
    fitted = train.agg(F.struct(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c)
                                  for c in columns]).alias("f")).scalar()
    scaled = {}
    for c in columns:
        stats = fitted[c]
        spread = F.when(stats["std"] == 0, 1.0).otherwise(stats["std"])
        scaled[f"{c}_scaled"] = (F.col(c) - stats["mean"]) / spread
    return df.withColumns(scaled)


def quantile_cap(df: DataFrame, train: DataFrame, columns, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Values limited to the training quantiles; nulls stay."""
    rows = quantiles(long_values(train, list(columns)), [low, high], ["column"]).collect()  # two rows per column
    bound = {(r["column"], r["prob"]): r["quantile"] for r in rows}
    capped = {c: F.when(F.col(c).isNotNull(), F.greatest(
        F.lit(bound[c, low]), F.least(F.lit(bound[c, high]), F.col(c).cast("double")))) for c in columns}
    return df.withColumns(capped)


def coerce_numeric(df: DataFrame, exclude) -> DataFrame:
    """Every column but the excluded ones as a number; unreadable text becomes null."""
    return df.select(*[F.col(c) if c in exclude else F.col(c).try_cast("double").alias(c) for c in df.columns])


def feature_columns(df: DataFrame, exclude=()) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature columns."""
    dropped = {*ID_LIKE, *LEAKAGE, *exclude, "snapshot_date"}
    numeric = [c for c in numeric_columns(df) if c not in dropped]
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in dropped]
    return numeric, text


def feature_list(df: DataFrame, exclude=(), trained=None) -> DataFrame:
    """Kind and number of values per column, and how it compares with the trained columns."""
    numeric, text = feature_columns(df, exclude)
    used = {**dict.fromkeys(numeric, "numeric"), **dict.fromkeys(text, "categorical")}
    names = [*df.columns, *[c for c in (trained or []) if c not in df.columns]]
    known = set(trained) if trained is not None else set(used)
    def status(c):
        if c not in df.columns:
            return "missing"
        if c not in used:
            return "excluded"
        return "ok" if c in known else "extra"
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit(used.get(c, "none")).alias("kind"), F.lit(status(c)).alias("status"),
        (F.col(f"`{c}`") if c in df.columns else F.lit(0).cast("bigint")).alias("n_values")) for c in names])
    return counts.select(F.inline(rows))
