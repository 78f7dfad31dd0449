"""Near-duplicate vectors by Euclidean p-stable hashing, with exact cosine checks.

Normalised vectors within cosine c are within Euclidean distance sqrt(2 - 2c). A hash is a row of quantised random
projections floor((a.x + b) / w); two vectors share one with a probability that falls with their distance, and a table's
key joins ``k`` of them. ``k`` and the number of tables follow from the number of vectors and the allowed chance of
missing a pair right at the threshold (closer pairs are missed far less often), so the rule is the same at every size.

Equal vectors of a label are one class with a count. Only keys that several classes of a label share are looked at; the
classes of a key are compared in blocks, each pair in the first table where it meets, and only link counts and a spanning
forest leave the task. A key with more classes than a block holds is dealt out as pairs of blocks.

Defined cases: a vector that is null, empty, zero or holds null or non-finite numbers, or has a null label, links with
nothing and is its own component; vectors of different length never link; repeated rows link with each other; a null id
never names a component unless all of it is null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.llm.common import runs, stage
from delayworks.llm.graph import components, merge

THRESHOLD = 0.98
MISS = 1e-6
#: Width of a quantised step, in units of the distance at the threshold.
STEP = 8.0
#: Distance from which vectors count as unrelated: in a key of ``k`` projections about one of n such pairs per vector meets.
UNRELATED = 1.2
BLOCK = 2048
SEED = 20240607


def _hit(distance: float, width: float) -> float:
    """Chance that one quantised projection is equal at this distance."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def settings(n: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[float, int, int]:
    """Step width, projections per key and tables for ``n`` vectors: unrelated ones should rarely share a key."""
    near = math.sqrt(max(1e-6, 2 - 2 * threshold))
    width = STEP * near
    k = max(2, math.ceil(math.log(max(n, 2)) / -math.log(_hit(UNRELATED, width))))
    tables = math.ceil(math.log(miss) / math.log1p(-_hit(near, width) ** k))
    return width, k, tables


def digests(vectors: pa.Array) -> pa.Array:
    """16 bytes that name a usable vector's exact values; null for one that cannot link."""
    out: list[bytes | None] = []
    for i in range(len(vectors)):
        item = vectors[i]
        out.append(None)
        if item.is_valid and len(item.values) and not item.values.null_count:
            x = item.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(x).all() and x.any():
                out[-1] = hashlib.blake2b((x + 0.0).tobytes(), digest_size=16).digest()
    return pa.array(out, pa.binary())


def unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def keys_of(x: np.ndarray, width: float, k: int, tables: int) -> np.ndarray:
    """One 64-bit key per vector and table."""
    rng = np.random.default_rng([SEED, x.shape[1]])
    lines, shift = rng.standard_normal((x.shape[1], k * tables)), rng.uniform(0, width, k * tables)
    cells = np.floor((x @ lines + shift) / width).astype(np.int64).reshape(len(x), tables, k).view(np.uint64)
    mix = rng.integers(1, 1 << 63, k, dtype=np.uint64) | np.uint64(1)
    h = (cells * mix).sum(axis=2, dtype=np.uint64) + np.arange(tables, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    return (h * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def hasher(width: float, k: int, tables: int):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.diff(batch.column("vec").offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                keys = keys_of(unit(matrix(rows.column("vec"))), width, k, tables)
                offsets = pa.array(np.arange(0, keys.size + 1, tables, dtype=np.int32))
                codes = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([*rows.columns, codes], [*rows.schema.names, "codes"])

    return hashed


def block_links(x: np.ndarray, codes: np.ndarray, sizes: np.ndarray, slot: int, part: np.ndarray, crossed: bool,
                threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links first met in table ``slot``: how many vectors each row gains, and the root of its linked rows."""
    n = len(x)
    gained, root = np.zeros(n, np.int64), np.arange(n)
    for start in range(0, n, 512):
        rows = slice(start, min(n, start + 512))
        i, j = np.nonzero(x[rows] @ x[start:].T >= threshold)
        i, j = i + start, j + start
        keep = (i < j) & ((part[i] != part[j]) | (not crossed))
        i, j = i[keep], j[keep]
        for lo in range(0, len(i), 1 << 16):
            a, b = i[lo:lo + (1 << 16)], j[lo:lo + (1 << 16)]
            if slot:
                new = ~(codes[a, :slot] == codes[b, :slot]).any(axis=1)
                a, b = a[new], b[new]
            np.add.at(gained, a, sizes[b])
            np.add.at(gained, b, sizes[a])
            root = merge(root, a, b)
    return gained, root


def comparer(threshold: float):
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in runs(batches, ["label", "slot", "code", "lo", "hi"]):
            found: list[tuple[np.ndarray, ...]] = []
            slots, lows, highs = (table.column(c).to_numpy() for c in ("slot", "lo", "hi"))
            for begin, end in zip(at, at[1:]):
                if end - begin < 2:
                    continue
                group = table.slice(begin, end - begin)
                dims = pc.list_value_length(group.column("vec")).to_numpy()
                for dim in np.unique(dims).tolist():
                    rows = group.filter(pa.array(dims == dim)) if dims.min() < dims.max() else group
                    cid = rows.column("cid").to_numpy()
                    gained, root = block_links(
                        unit(matrix(rows.column("vec"))), matrix(rows.column("codes")), rows.column("n").to_numpy(),
                        int(slots[begin]), rows.column("part").to_numpy(), bool(lows[begin] != highs[begin]), threshold)
                    some = gained > 0
                    found.append((cid[some], gained[some], cid[root][some]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["cid", "gained", "root"])

    return compared


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label",
                    threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """``(id, n_links, component)`` for every row: vectors linked directly, and the smallest id reachable by links."""
    digest = F.arrow_udf("binary")(digests)
    rows = vectors.select(F.col(id_col).alias("id"), (F.col(label_col) if label_col else F.lit(0)).alias("label"),
                          F.col(vec_col).alias("vec"))
    rows = stage(rows.withColumn("digest", F.when(F.col("label").isNotNull(), digest("vec"))), "vectors")
    classes = (rows.where("digest is not null").groupBy("label", "digest")
               .agg(F.min("id").alias("first"), F.count("*").alias("n"), F.first("vec").alias("vec")))
    classes = stage(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    width, k, tables = settings(classes.count(), threshold, miss)
    fields = classes.select("cid", "label", "n", "vec")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields.schema)
    coded = stage(fields.mapInArrow(hasher(width, k, tables), f"{kinds}, codes array<long>"), "codes")
    spread = coded.select("cid", "label", F.posexplode("codes").alias("slot", "code"))
    keys = ["label", "slot", "code"]
    busy = spread.groupBy(*keys).agg(F.count("*").alias("m")).where("m > 1")
    meet = (spread.join(busy, keys)
            .withColumn("parts", F.ceil(F.col("m") / BLOCK).cast("int"))
            .withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("cid", *keys, "part", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi")))
    dealt = (meet.join(coded.select("cid", "n", "vec", "codes"), "cid")
             .repartition(*keys, "lo", "hi").sortWithinPartitions(*keys, "lo", "hi"))
    found = stage(dealt.mapInArrow(comparer(threshold), "cid long, gained long, root long"), "links")
    joined = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    gains = found.groupBy("cid").agg(F.sum("gained").alias("gained"))
    named = classes.join(joined.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    lowest = named.groupBy("component").agg(F.min("first").alias("lowest"))
    known = (named.select("cid", "label", "digest", "n", "component").join(lowest, "component").join(gains, "cid", "left")
             .select("label", "digest", "lowest", (F.col("n") - 1 + F.coalesce("gained", F.lit(0))).alias("links")))
    return rows.join(known, ["label", "digest"], "left").select(
        "id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("lowest", "id").alias("component"))
