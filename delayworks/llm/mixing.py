"""Mixing sources to target weights.

Words are packed, source by source, into blocks of a fixed number of words. The mix is a row of slots, cut into output
shards. How many slots of a shard each source fills is a multinomial draw conditioned on the sources' totals (a
multivariate hypergeometric draw by halving the shards again and again), so totals are met exactly and any shard can be
drawn alone. A source's n-th slot is mapped to a block by a pseudorandom permutation of the source's block numbers, a new
one for every pass over the source, and blocks are joined by number: no block is used again before all have been used.

A source's target may not exceed ``MOST`` times its size; what it cannot take is shared anew by weight.

Everything follows from the seed and the rows, so a rerun gives the same mix. Defined cases: a null text has size 0, a
null source is a source, the last in order; rows with no words are kept with nothing taken; repeated rows are laid out
and taken separately; an empty table gives an empty mix. Only the named columns are read. The list of sources, one row
each, is held by the driver: that is the bound on what it collects.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from delayworks.llm.common import free_name, row_key, stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 128
SHARD_SLOTS = 4096
#: Documents of a source that are laid out together.
SALT_ROWS = 5_000
SEED = 11
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Targets in the order of ``sizes``: by weight, stopped at ``most`` times the size, the excess shared anew."""
    w = np.array([weights[i % len(weights)] for i in range(len(sizes))], float)
    cap = np.array([most * n for _, n in sizes], float)
    out, left = np.zeros(len(sizes)), share * float(sum(n for _, n in sizes))
    is_open = np.ones(len(sizes), bool)
    while is_open.any():
        part = np.where(is_open, left * w / w[is_open].sum(), 0.0)
        over = is_open & (part > cap)
        if not over.any():
            out[is_open] = part[is_open]
            break
        out[over] = cap[over]
        left = max(0.0, left - cap[over].sum())
        is_open &= ~over
    return out.tolist()


@dataclass
class Source:
    name: str | None
    size: int
    target: float
    blocks: int
    slots: int


def sources_of(sizes: list[tuple[str | None, int]], block: int) -> list[Source]:
    """Sources by code point, null last, with their targets and how many slots meet them."""
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    out = []
    for (name, size), target in zip(ordered, targets(ordered)):
        blocks = -(-size // block)
        passes = int(target // size) if size else 0
        rest = round((target - passes * size) / (size / blocks)) if size else 0
        out.append(Source(name, size, target, blocks, min(MOST * blocks, passes * blocks + rest)))
    return out


def _hyper(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Hypergeometric draw; beyond numpy's range, its normal form within the possible values."""
    if not good or not n:
        return 0
    if good + bad < 10 ** 9:
        return int(rng.hypergeometric(good, bad, n))
    total = good + bad
    p = good / total
    spread = (n * p * (1 - p) * (total - n) / max(1, total - 1)) ** 0.5
    return int(np.clip(round(n * p + spread * rng.standard_normal()), max(0, n - bad), min(n, good)))


def shard_runs(shard: int, shards: int, slots: list[int], size: int, seed: int = SEED) -> list[tuple[int, int]]:
    """Per source, the first of its slots in this shard and how many: one path down the halving tree."""
    total = sum(slots)
    lo, hi, first, counts = 0, shards, [0] * len(slots), list(slots)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        want, held = min(mid * size, total) - lo * size, sum(counts)
        left = []
        for c in counts:
            k = _hyper(rng, c, held - c, want)
            left.append(k)
            want, held = want - k, held - c
        if shard < mid:
            hi, counts = mid, left
        else:
            lo, first, counts = mid, [f + k for f, k in zip(first, left)], [c - k for c, k in zip(counts, left)]
    return list(zip(first, counts))


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Pseudorandom permutation of 0 .. n - 1: a four-round Feistel network, walked until it falls below n."""
    if n <= 1:
        return index.copy()
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    salts = np.random.default_rng([SEED, key]).integers(1, 1 << 63, 4, dtype=np.uint64)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for salt in salts:
            h = (right + salt) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((h >> np.uint64(32)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def slots_of(sources: list[Source], shards: int, size: int, seed: int):
    blocks, slots = [s.blocks for s in sources], [s.slots for s in sources]

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                rows = []
                for k, (first, count) in enumerate(shard_runs(shard, shards, slots, size, seed)):
                    if count:
                        n = np.arange(first, first + count)
                        for turn in np.unique(n // blocks[k]).tolist():
                            part = n[n // blocks[k] == turn] % blocks[k]
                            index = permute(part, blocks[k], (k << 8) + turn)
                            rows.append((np.full(len(part), k, np.int32), index, np.full(len(part), turn, np.int32)))
                source, index, turn = (np.concatenate(x) for x in zip(*rows))
                place = np.random.default_rng([seed, 7, shard]).permutation(len(index))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(source), pa.array(index), pa.array(turn), pa.array(np.full(len(index), shard)), pa.array(place)],
                    ["source_no", "block", "pass", "shard", "slot"])

    return drawn


@dataclass
class Mix:
    rows: DataFrame  # one per document: row (source_no, salt, place), id, key, size, source_size, target
    taken: DataFrame  # one per piece of a slot: row, block, first (word of the document), words, pass, shard, slot
    sources: list[Source]


ROW = ["source_no", "salt", "place"]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK_WORDS,
        shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> Mix:
    spark = docs.sparkSession
    sized = stage(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), row_key(id_col, text_col).alias("key"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "sizes")
    counted = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    sources = sources_of([(r.source, int(r.size)) for r in counted], block)
    rows = {r.source: r.n for r in counted}
    names = spark.createDataFrame([(s.name, i, s.size, s.target, -(-rows[s.name] // SALT_ROWS)) for i, s in enumerate(sources)],
                                  "name string, source_no int, source_size long, target double, salts int")
    numbered = (sized.join(F.broadcast(names), sized["source"].eqNullSafe(names["name"]))
                .withColumn("salt", F.pmod(F.xxhash64("key"), F.col("salts")).cast("int")))
    # a source's words are laid out salt by salt, so that no window holds a whole source
    within = Window.partitionBy("source_no", "salt").orderBy(F.asc_nulls_first("id"), "key")
    laid = (numbered.withColumn("place", F.row_number().over(within))
            .withColumn("upto", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    laid = stage(laid.select(*ROW, "id", "key", "size", "source_size", "target", (F.col("upto") - F.col("size")).alias("offset")), "laid-out")
    by_salt = laid.groupBy("source_no", "salt").agg(F.sum("size").alias("held"))
    before = Window.partitionBy("source_no").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_salt.select("source_no", "salt", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    placed = laid.where("size > 0").join(bases, ["source_no", "salt"]).withColumn("offset", F.col("offset") + F.col("base"))
    begin, end = F.col("block") * block, (F.col("block") + 1) * block
    pieces = (placed.select(*ROW, "offset", "size", F.explode(F.sequence(
        (F.col("offset") / block).cast("long"), ((F.col("offset") + F.col("size") - 1) / block).cast("long"))).alias("block"))
        .select(*ROW, "block", F.greatest(begin - F.col("offset"), F.lit(0)).alias("first"),
                (F.least(end, F.col("offset") + F.col("size")) - F.greatest(begin, F.col("offset"))).alias("words")))
    total = sum(s.slots for s in sources)
    shards = max(1, -(-total // shard_slots))
    drawn = (spark.range(shards if total else 0).mapInArrow(
        slots_of(sources, shards, shard_slots, seed), "source_no int, block long, pass int, shard long, slot long"))
    # the planner sizes the slots by the few shards they are drawn from and would broadcast them
    taken = pieces.join(drawn.hint("merge"), ["source_no", "block"])
    return Mix(laid.drop("offset"), taken, sources)


def taken_words(mixed: Mix) -> DataFrame:
    """Every document with the words that the mix takes of it, repeats counted."""
    sums = mixed.taken.groupBy(*ROW).agg(F.sum("words").alias("taken"))
    return mixed.rows.join(sums, ROW, "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def cut_words(text: str, runs: list[tuple[int, int]], pattern) -> str:
    """The words in ``runs`` (first, number; ascending) with the white space after them as it stands in the text.

    A run of all words is the whole text from its first word on.
    """
    starts = [m.start() for m in pattern.finditer(text)]
    ends = [*starts[1:], len(text)]
    return "".join(text[starts[a]:ends[a + n - 1]] for a, n in runs)


def texts(docs: DataFrame, mixed: Mix, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that the mix takes words of, their text being those words. A second pass follows the first on a new line.

    Other columns stay; a repeated row is there once for each of its rows that is taken from.
    """
    pattern = re.compile(WORD)
    key = free_name(docs, "key")
    runs = (mixed.taken.groupBy(*ROW).agg(F.array_sort(F.collect_list(F.struct("pass", "first", "words"))).alias("runs"))
            .join(mixed.rows.select(*ROW, "key"), ROW).select(F.col("key").alias(key), F.col("runs").alias(f"{key}runs")))
    whole = docs.withColumn(key, row_key(id_col, text_col)).dropDuplicates([key])

    @F.arrow_udf("string")
    def cut(text: pa.Array, runs: pa.Array) -> pa.Array:
        out = []
        for t, parts in zip(text.to_pylist(), runs.to_pylist()):
            by_pass: dict[int, list[tuple[int, int]]] = {}
            for p in parts:
                by_pass.setdefault(p["pass"], []).append((p["first"], p["words"]))
            out.append("\n".join(cut_words(t, r, pattern) for _, r in sorted(by_pass.items())))
        return pa.array(out, pa.string())

    joined = whole.join(runs, key)
    return joined.withColumn(text_col, cut(F.col(text_col), F.col(f"{key}runs"))).select(*docs.columns)
