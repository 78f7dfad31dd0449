"""Document fingerprints by one-permutation MinHash, in DataFrame expressions only.

Every shingle of five words is hashed once. The top bits of a hash name its bin, the smallest hash of a bin is kept. An
empty bin takes the value of a filled one: each bin tries bins in a pseudorandom order of its own (the optimal
densification: the bin it stops at depends on nothing but which bins are filled). The low-order byte of every
bin is stored. Two fingerprints agree by chance in one byte of 256, and the likeness is corrected for that.

Defined cases: a text under five words is one shingle, a null text is empty; a text without words has the fingerprint of
no shingle at all, which is like itself only; equal texts have equal fingerprints. Successors are by ascending id, nulls
first, rows of one id by a hash of their text; after the last row comes the first, and a single row follows itself.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

WORDS = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
LOW_BITS = 8
#: Bins that an empty bin looks at one by one before it ranks all filled ones; few texts are short enough to need that.
TRIES = 16
BLANK = r"[\x20\x09-\x0D]+"
#: Rows of one ordered bucket. Buckets are cut in two levels, each at most so many ways: the driver holds at most a million
#: cut points, and buckets grow beyond 500 rows only from 500 million rows on (50 MB of text for each ten thousand).
BUCKET_ROWS = 500
MOST_CUTS = 1000


def words_of(text: Column) -> Column:
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{BLANK}|{BLANK}$", "")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK))


def _bin(x: Column) -> Column:
    return (F.shiftright(x, 64 - BIN_BITS) + BINS // 2).cast("int")


def with_signature(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds an array of ``BINS`` bytes; empty for a text without words.

    The steps are columns of their own so that an array used several times is computed once.
    """
    w, s, m = f"{name}_w", f"{name}_s", f"{name}_m"
    df = df.withColumn(w, F.transform(words_of(F.col(text)), lambda x: F.xxhash64(x)))
    at = lambda i, k: F.get(F.col(w), i + k)
    spans = F.transform(F.sequence(F.lit(0), F.size(w) - WORDS), lambda i: F.xxhash64(*(at(i, k) for k in range(WORDS))))
    shingles = F.when(F.size(w) >= WORDS, spans).when(F.size(w) > 0, F.array(F.xxhash64(F.col(w)))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(s, F.sort_array(shingles)).drop(w)
    # sorted hashes are sorted by bin: the first of each bin is its smallest
    first = F.filter(F.col(s), lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(F.col(s), i - 1))))
    df = df.withColumn(m, first).drop(s)
    here, none = F.col(m), F.lit(None).cast("bigint")
    gap = lambda x, i: _bin(x) - F.when(i == 0, F.lit(-1)).otherwise(_bin(F.get(here, i - 1))) - 1
    spread = F.concat(F.flatten(F.transform(here, lambda x, i: F.concat(F.array_repeat(none, gap(x, i)), F.array(x)))),
                      F.array_repeat(none, BINS - 1 - _bin(F.element_at(here, -1))))

    def borrowed(i: Column) -> Column:
        # the filled bin that comes first in the order of bin i: smallest hash of both, its place in the low bits
        keys = F.transform(here, lambda x, p: F.xxhash64(i, _bin(x)).bitwiseAND(F.lit(-BINS)).bitwiseOR(p.cast("bigint")))
        return F.get(here, F.array_min(keys).bitwiseAND(F.lit(BINS - 1)).cast("int"))

    dense = f"{name}_d"
    df = df.withColumn(dense, F.when(F.size(m) == 0, F.array().cast("array<bigint>")).when(F.size(m) == BINS, here).otherwise(spread))
    tries = lambda i: (F.get(F.col(dense), F.xxhash64(i, F.lit(t)).bitwiseAND(F.lit(BINS - 1)).cast("int")) for t in range(TRIES))
    full = F.transform(F.col(dense), lambda x, i: F.coalesce(x, *tries(i), borrowed(i)))
    low = F.transform(full, lambda x: (x.bitwiseAND(F.lit((1 << LOW_BITS) - 1)) - 128).cast("tinyint"))
    return df.withColumn(name, low).drop(m, dense)


def packed(signature: Column | str) -> Column:
    """The signature as lower-case hexadecimal digits; zeros for no shingle."""
    col = F.col(signature) if isinstance(signature, str) else signature
    digits = F.transform(col, lambda x: F.substring(F.hex(x.cast("int") + 128 + 256), 2, 2))
    return F.when(F.size(col) == 0, F.lit("0" * (2 * BINS))).otherwise(F.lower(F.array_join(digits, "")))


def likeness(a: Column | str, b: Column | str) -> Column:
    """Estimated share of common shingles, corrected for bytes that agree by chance."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    chance = 1 / (1 << LOW_BITS)
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / BINS
    none = (F.size(a) == 0) | (F.size(b) == 0)
    return (F.when(none, ((F.size(a) == 0) & (F.size(b) == 0)).cast("double"))
            .otherwise(F.greatest(F.lit(0.0), (equal - chance) / (1 - chance))))


def _passed(cuts: Column, id_col: str) -> Column:
    """How many of the cut points an id has reached."""
    return F.coalesce(F.size(F.filter(cuts, lambda c: c <= F.col(id_col))), F.lit(0))


def with_guards(rows: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows in ordered buckets of about even size (``bucket``), the first rows of the next bucket added to each
    (``guard``), so that a row finds its successor in its own bucket. ``ids`` is the id column of the same rows."""
    seen = ids.agg(F.count("*").alias("n"), F.count(id_col).alias("known")).first()
    buckets = math.ceil(seen.n / BUCKET_ROWS) if seen.known else 1
    ways = min(MOST_CUTS, math.ceil(math.sqrt(buckets)))
    kind = ids.schema[id_col].dataType
    steps = F.percentile_approx(id_col, [i / ways for i in range(1, ways)], 20 * ways).alias("q") if ways > 1 else None
    number = F.lit(0)
    if ways > 1:
        coarse = sorted(set(ids.agg(steps).first().q))
        above = _passed(F.array(*(F.lit(c).cast(kind) for c in coarse)), id_col)
        within = {r.part: sorted(set(r.q)) for r in ids.where(F.col(id_col).isNotNull()).groupBy(above.alias("part")).agg(steps).collect()}
        fine = F.array(*(F.array(*(F.lit(c).cast(kind) for c in within.get(i, []))).cast(T.ArrayType(kind)) for i in range(len(coarse) + 1)))
        number = above * ways + _passed(F.get(fine, above), id_col)
    number = F.when(F.col(id_col).isNull(), F.lit(0)).otherwise(number).cast("int")
    starts = (ids.select(id_col).withColumn("bucket", number).groupBy("bucket")
              .agg(F.min(id_col).alias("low"), F.max(F.col(id_col).isNull()).alias("has_null")).collect())
    order = sorted(((r.bucket, None if r.has_null else r.low) for r in starts))
    guards = [(b, order[(i + 1) % len(order)][1]) for i, (b, _) in enumerate(order)]
    ahead = rows.sparkSession.createDataFrame(guards, f"bucket int, first {kind.simpleString()}")
    own = rows.withColumn("bucket", number).withColumn("guard", F.lit(False))
    extra = rows.join(F.broadcast(ahead), rows[id_col].eqNullSafe(ahead["first"])).drop("first").withColumn("guard", F.lit(True))
    return own.unionByName(extra)


def with_next(guarded: DataFrame, carry: list[str], id_col: str = "id") -> DataFrame:
    """Adds ``next_<c>`` for the carried columns of the following row, and drops the guards."""
    by_id = Window.partitionBy("bucket").orderBy("guard", F.asc_nulls_first(id_col), "tie")
    for c in carry:
        guarded = guarded.withColumn(f"next_{c}", F.lead(c).over(by_id))
    return guarded.where(~F.col("guard")).drop("bucket", "guard")


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by the first as many of the following text (or all it has)."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text, signature)`` of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return with_signature(rows, "text", "signature")


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's fingerprint, that of its edited text, and its likeness to both that and the next row's."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    guarded = with_guards(rows, docs.select(F.col(id_col).alias("id")))
    follow = with_next(with_signature(guarded, "text", "signature"), ["text", "signature"])
    changed = follow.withColumn("changed", edited(F.col("text"), F.col("next_text"))).drop("next_text")
    changed = changed.select("id", F.length("text").alias("n_chars"), F.sha2("changed", 256).alias("edited_sha256"), "signature",
                             "next_signature", "changed")
    both = with_signature(changed, "changed", "edited_signature")
    return both.select("id", "n_chars", "edited_sha256", packed("signature").alias("fingerprint"),
                       packed("edited_signature").alias("edited_fingerprint"), likeness("signature", "edited_signature").alias("near_edited"),
                       likeness("signature", "next_signature").alias("near_next"))
