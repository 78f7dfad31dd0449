"""Exact order statistics without putting a whole table, class or group into one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from delayworks.operators.joins import lookup_join
from delayworks.sources.staging import stage

PREFIX = 4  # hexadecimal digits: 65,536 slices of the hash range
HASH_DIGITS = 32
SLICE_ROWS = 2_000_000  # rows of one slice of a running total
EDGE_ROWS = 1_000_000  # rows of a slice that one task may rank


def running_totals(df: DataFrame, group: list[str], order: list[str], measures: list[str]) -> DataFrame:
    """Add ``before_<m>`` and ``total_<m>``: sums of a measure over the rows of the group that
    come earlier, and over the whole group.

    ``df`` has one row per (group, order) value. It is staged, so that finding the slice
    bounds does not compute it a second time. The rows are range-partitioned into slices
    of even size, as many as the number of rows asks for; a window runs inside each slice only, and the slice totals, at most one
    row per slice and group, are accumulated and joined back.
    """
    counts = stage(df, "counts")
    slices = max(1, math.ceil(counts.count() / SLICE_ROWS))
    ranged = counts.repartitionByRange(slices, *group, *order).withColumn("_slice", F.spark_partition_id())
    ranged = stage(ranged, "running")
    totals = ranged.groupBy(*group, "_slice").agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    per_group = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    earlier = per_group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group, "_slice",
        *[F.coalesce(F.sum(f"_sum_{m}").over(earlier), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(f"_sum_{m}").over(per_group).alias(f"total_{m}") for m in measures],
    )
    inside = Window.partitionBy(*group, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = lookup_join(ranged, offsets, [*group, "_slice"], "inner")
    before = {f"before_{m}": F.col(f"_off_{m}") + F.coalesce(F.sum(m).over(inside), F.lit(0)) for m in measures}
    return rows.withColumns(before).drop("_slice", *[f"_off_{m}" for m in measures])


def numbered(df: DataFrame, order: list[str], name: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``name``: the row's number from 0 in this order, nulls first; equal rows in any order.

    Rows are range-partitioned into even slices and sorted inside them; the driver holds one row count per slice.
    """
    tied = stage(df, "unnumbered").withColumn("_tie", F.monotonically_increasing_id())
    slices = max(1, math.ceil(tied.count() / slice_rows))
    sort = [*order, "_tie"]
    placed = stage(tied.repartitionByRange(slices, *sort).sortWithinPartitions(*sort).drop("_tie")
                   .withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    bases, base = [], 0
    for r in placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect():  # a row per slice
        bases.append((r["_part"], base))
        base += r["n"]
    lookup = df.sparkSession.createDataFrame(bases, "_part long, _base long")
    return lookup_join(placed.withColumn("_part", part), lookup, ["_part"], "inner").withColumn(
        name, F.col("_base") + row).drop("_part", "_base", "_at")


def carried_last(df: DataFrame, order: list[str], value: str, name: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``name``: the last value that is not null at or before each row in this order, nulls first.

    Rows are range-partitioned into even slices, equal ones spread over several if need be; a window runs inside each
    slice only, and what a slice inherits is the last value of the slices before it (one row per slice on the driver).
    """
    tied = stage(df, "uncarried").withColumn("_tie", F.monotonically_increasing_id())
    slices = max(1, math.ceil(tied.count() / slice_rows))
    ranged = stage(tied.repartitionByRange(slices, *order, "_tie").withColumn("_slice", F.spark_partition_id()), "slices")
    ends = (ranged.groupBy("_slice").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order, "_tie"))).alias("last"))
            .orderBy("_slice").collect())
    inherited, last = [], None
    for r in ends:
        inherited.append((r["_slice"], last))
        last = r["last"] if r["last"] is not None else last
    kind = df.schema[value].dataType.simpleString()
    lookup = df.sparkSession.createDataFrame(inherited, f"_slice int, _inherited {kind}")
    upto = Window.partitionBy("_slice").orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = lookup_join(ranged, lookup, ["_slice"], "inner")
    return rows.withColumn(name, F.coalesce(F.last(value, ignorenulls=True).over(upto), "_inherited")).drop("_slice", "_tie", "_inherited")


def long_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) rows of the numeric columns, nulls left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value"))
                      for c in columns])
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull())


def quantiles(long: DataFrame, probs: list[float], group: list[str]) -> DataFrame:
    """Exact, linearly interpolated quantiles of ``value`` per group: (group, prob, quantile).

    Values are counted first, so that a frequent value is one row, then located by
    their running count.
    """
    counts = long.groupBy(*group, "value").agg(F.count("*").alias("n"))
    return interpolate(running_totals(counts, group, ["value"], ["n"]), probs, group)


def interpolate(placed: DataFrame, probs: list[float], group: list[str]) -> DataFrame:
    """Quantiles out of values with their count ``n`` and its running total."""
    first, last = F.col("before_n"), F.col("before_n") + F.col("n") - 1
    wanted = F.array(*[F.struct(
        F.lit(float(p)).alias("prob"),
        (F.lit(float(p)) * (F.col("total_n") - 1)).alias("at"),
    ) for p in probs])
    hit = lambda w: F.floor(w["at"]).between(first, last) | F.ceil(w["at"]).between(first, last)
    near = placed.withColumn("_w", F.filter(wanted, hit)).where(F.size("_w") > 0)
    near = near.select(*group, "value", first.alias("first"), last.alias("last"), F.inline("_w"))
    low = F.max(F.when(F.floor("at").between(F.col("first"), F.col("last")), F.col("value")))
    high = F.max(F.when(F.ceil("at").between(F.col("first"), F.col("last")), F.col("value")))
    ends = near.groupBy(*group, "prob", "at").agg(low.alias("low"), high.alias("high"))
    share = F.col("at") - F.floor("at")
    return ends.select(*group, "prob", (F.col("low") + (F.col("high") - F.col("low")) * share).alias("quantile"))


def hash_key(keys: list[str]) -> Column:
    """Hash of the key columns, used as a fixed random order."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def hash_select(df: DataFrame, keys: list[str], strata: list[str] | None = None,
                fraction: float | None = None, limit: int | None = None, flag: str = "selected") -> DataFrame:
    """Mark an exact share or number of rows per stratum: the first ones in hash order.

    Rows are ordered by the hash of ``keys``, rows that share it by a hash of all their columns; of equal rows any will
    do, so they are counted and dealt out again. A null stratum is a stratum. A histogram over hash prefixes finds the
    slice that the cut falls into, and the prefix is made longer until that slice is small; only its hashes are ranked.
    Rows away from the cut are neither sorted nor shuffled.
    """
    group = strata or ["_g"]
    base = df if strata else df.withColumn("_g", F.lit(0))
    every = [F.col(f"`{c}`") for c in df.columns]
    hashed = base.withColumn("_h", hash_key(keys))
    whole_row = F.md5(F.to_json(F.struct(*every)))  # only where rows of one key are told apart
    per = Window.partitionBy(*group)
    total = F.sum("n").over(per)
    quota = F.lit(limit) if fraction is None else F.floor(total * F.lit(fraction))
    counts = hashed.groupBy(*group, F.substring("_h", 1, PREFIX).alias("_p")).agg(F.count("*").alias("n"))
    running = per.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(running), F.lit(0))
    # At most 65,536 rows per stratum, whatever the number of rows counted.
    spots = stage(counts.select(*group, "_p", "n", total.alias("_all"), quota.cast("bigint").alias("_quota"), before.alias("before")), "histogram")
    falls = (F.col("before") < F.col("_quota")) & (F.col("before") + F.col("n") >= F.col("_quota"))
    edge = spots.where(falls).select(*group, "_p", "n", (F.col("_quota") - F.col("before")).alias("_need"))
    digits = PREFIX
    while digits < HASH_DIGITS and (edge.agg(F.max("n")).first()[0] or 0) > EDGE_ROWS:
        inside = _in_slice(hashed.select(*group, "_h"), edge, group, digits)
        digits += PREFIX
        counts = inside.groupBy(*group, F.substring("_h", 1, digits).alias("_p"), "_need").agg(F.count("*").alias("n"))
        finer = stage(counts.withColumn("before", before), "histogram")
        falls = (F.col("before") < F.col("_need")) & (F.col("before") + F.col("n") >= F.col("_need"))
        edge = finer.where(falls).select(*group, "_p", "n", (F.col("_need") - F.col("before")).alias("_need"))
    inside = _in_slice(hashed, edge, group, digits).withColumn("_t", whole_row)
    counted = inside.groupBy(*group, "_h", "_t", "_need").agg(F.count("*").alias("n"))
    upto = counted.withColumn("_upto", F.sum("n").over(per.orderBy("_h", "_t").rowsBetween(Window.unboundedPreceding, 0)))
    reached = (F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("n") < F.col("_need"))
    cut = upto.where(reached).select(*group, F.col("_h").alias("_cut_h"), F.col("_t").alias("_cut_t"),
                                     (F.col("_need") - F.col("_upto") + F.col("n")).alias("_take"), F.col("n").alias("_same"))
    bounds = lookup_join(spots.select(*group, "_all", "_quota").distinct(), cut, group, "left", null_safe=True)
    bounds = stage(bounds, "bounds")  # one row per stratum
    rows = lookup_join(hashed, bounds, group, "inner", null_safe=True)
    whole = F.col("_quota") >= F.col("_all")
    told = F.when(F.col("_h") == F.col("_cut_h"), whole_row)
    first = (F.col("_h") < F.col("_cut_h")) | (told < F.col("_cut_t"))
    at_cut = F.coalesce(~whole & (told == F.col("_cut_t")), F.lit(False))
    if not bounds.where("_take < _same").head(1):  # no equal rows to tell apart: one pass marks all
        return rows.withColumn(flag, whole | F.coalesce(first, F.lit(False)) | at_cut).select(*every, flag)
    clear = rows.where(~at_cut).withColumn(flag, whole | F.coalesce(first, F.lit(False))).select(*every, flag)
    copies = (rows.where(at_cut).groupBy(*group, "_take").agg(F.count("*").alias("n"), F.first(F.struct(*every)).alias("_row"))
              .withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))))
    return clear.unionAll(copies.select("_row.*", (F.col("_i") <= F.col("_take")).alias(flag)))


def _in_slice(hashed: DataFrame, edge: DataFrame, group: list[str], digits: int) -> DataFrame:
    """Rows of the slices in ``edge``, with how many of them are wanted."""
    keyed = hashed.withColumn("_p", F.substring("_h", 1, digits))
    return lookup_join(keyed, edge.select(*group, "_p", "_need"), [*group, "_p"], "inner", null_safe=True)


def bounded_sample(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """``limit`` rows (all if there are fewer), the first in hash order."""
    return hash_select(df, keys, limit=limit).where("selected").drop("selected")
