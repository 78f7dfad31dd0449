"""SimHash near-duplicates by anchor points of a covering code.

Fingerprint: a bit is set if more than half of the XXH64 hashes of a text's 3-word shingles (repeats count) have it set.

Search: 64 bits are two halves; a pair within 3 bits differs in at most one bit of one of them. Of each half, 31 bits are
covered by the perfect [31, 26] Hamming code: every word lies within 1 of exactly one anchor (covering radius 1). A
fingerprint's home is that anchor, and it is replicated to every anchor within radius plus threshold, 1 + 1 = 2: at most
16 of the 2^26 anchors of a half. So the home of either one of a pair holds the other, and only anchors are compared. The
anchor is the partitioning key. Those at home come first and are held against the rows after them; two replicas are never
compared. An anchor with more than ``BLOCK`` at home is dealt out in blocks of them, each with all members.

Only distinct fingerprints are compared: copies are members of their fingerprint and never pairs. Links inside an anchor
are reduced to a spanning forest before they leave the task, and components are found over those.

Defined cases: a null text is empty and gets fingerprint zero, which links like any other; texts under three words are one
shingle; rows with a null id keep their fingerprint and component but never name a component unless every member's id is
null (then it is null); repeated rows stay repeated; only the named id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayworks.llm.common import free_name, pieces, row_key, stage
from delayworks.llm.graph import components, merge

WORDS = 3
SEED = 42
THRESHOLD = 3
#: Rows that one comparison step looks at together.
STEP_ROWS = 1 << 16
#: An anchor is 31 bits and the number of its half; the number of a block stands above.
ANCHOR_BITS = 33
#: Fingerprints at home at an anchor that one task compares with its members.
BLOCK = 4096
#: Anchors with more are looked up by broadcast up to this many, joined beyond.
BROADCAST_ROWS = 100_000


def fingerprint_of(text: str | None, words: int = WORDS) -> int:
    tokens = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z and ASCII white space
    if not tokens:
        return 0
    shingles = list(map(b" ".join, zip(*(tokens[i:] for i in range(words))))) if len(tokens) >= words else [b" ".join(tokens)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], np.uint64)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), STEP_ROWS):
        part = hashes[i:i + STEP_ROWS].astype("<u8").view(np.uint8)
        bits += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(sum(1 << k for k in np.flatnonzero(bits * 2 > len(hashes)).tolist()))


def fingerprint(text: Column | str) -> Column:
    """64-bit fingerprint (as a signed long) of a whole text."""

    @F.arrow_udf("long")
    def prints(column: pa.Array) -> pa.Array:
        out = [fingerprint_of(t) for piece in pieces(column) for t in piece.to_pylist()]
        return pa.array(np.array(out, np.uint64).view(np.int64), pa.int64())

    return prints.asNondeterministic()(F.col(text) if isinstance(text, str) else text)


def _parities() -> np.ndarray:
    """Column i of the code's parity check is the number i + 1: the syndrome of a single flipped bit names it."""
    return np.arange(1, 32, dtype=np.uint32)


def syndrome(words: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words), np.uint32)
    for i, column in enumerate(_parities()):
        out ^= ((words >> np.uint32(i)) & np.uint32(1)) * column
    return out


def _pairs_of() -> list[tuple[np.ndarray, np.ndarray]]:
    """For every syndrome s, the pairs of bits whose columns add up to s."""
    table = []
    for s in range(32):
        first = [i for i in range(1, 32) if 0 < (i ^ s) < 32 and i < (i ^ s)] if s else []
        table.append((np.array([1 << (i - 1) for i in first], np.uint32), np.array([1 << ((i ^ s) - 1) for i in first], np.uint32)))
    return table


def anchors(words: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Home anchor of each 31-bit word, and (rows, anchors) of all other anchors within distance 2."""
    s = syndrome(words)
    home = words ^ np.where(s > 0, np.uint32(1) << (np.maximum(s, 1) - np.uint32(1)), np.uint32(0)).astype(np.uint32)
    others = []
    for value, (one, two) in enumerate(_pairs_of()):
        rows = np.flatnonzero(s == value)
        if value and len(rows) and len(one):
            flips = one ^ two
            others.append((np.repeat(rows, len(flips)), (words[rows][:, None] ^ flips[None, :]).ravel()))
    return home, others


def replicas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, fp, home) rows: a fingerprint at its home anchor and at every other one within 2, for both halves."""
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        bits = fp.view(np.uint64)
        for start in range(0, len(fp), STEP_ROWS):
            part, whole = bits[start:start + STEP_ROWS], fp[start:start + STEP_ROWS]
            for half in (0, 1):
                words = ((part >> np.uint64(32 * half)) & np.uint64(0x7FFFFFFF)).astype(np.uint32)
                home, others = anchors(words)
                rows = np.concatenate([np.arange(len(words)), *(r for r, _ in others)])
                codes = np.concatenate([home, *(a for _, a in others)]).astype(np.int64) | (half << 32)
                at_home = np.arange(len(rows)) < len(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes), pa.array(whole[rows]), pa.array(at_home)], ["anchor", "fp", "home"])


def compare(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of rows sorted by anchor, those at home first: each of them is held against the rows after it, one
    step further each time, while the anchor lasts."""
    bits = fp.view(np.uint64)
    root = np.arange(len(fp))
    active, shift = np.flatnonzero(home), 1
    while True:
        active = active[active + shift < len(fp)]
        active = active[anchor[active + shift] == anchor[active]]
        if not len(active):
            break
        other = active + shift
        near = np.bitwise_count(bits[active] ^ bits[other]) <= threshold
        root = merge(root, active[near], other[near])
        shift += 1
    linked = np.flatnonzero(root != np.arange(len(fp)))
    return fp[linked], fp[root[linked]]


def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links per anchor of a partition sorted by anchor. Whole anchors are compared, whatever batch they came in."""
    held: list[tuple[np.ndarray, ...]] = []

    def flush(rows):
        a, b = compare(*rows)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "fp", "home")))
        if held[0][0][0] == held[-1][0][-1] or sum(len(h[0]) for h in held) < STEP_ROWS:
            continue
        rows = [np.concatenate(x) for x in zip(*held)]
        cut = int(np.searchsorted(rows[0], rows[0][-1]))
        yield from flush([x[:cut] for x in rows])
        held = [tuple(x[cut:] for x in rows)]
    if held:
        yield from flush([np.concatenate(x) for x in zip(*held)])


def link_fingerprints(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct values of column ``fp`` (a stored table) within the threshold."""
    spread = prints.select("fp").mapInArrow(replicas, "anchor long, fp long, home boolean")
    parts = F.ceil(F.col("n") / block).cast("int")
    crowded = stage(spread.where("home").groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > block)
                    .select("anchor", parts.alias("parts")), "crowded-anchors")
    many = crowded.count()
    if many:
        lookup = F.broadcast(crowded) if many <= BROADCAST_ROWS else crowded
        own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        dealt = (spread.join(lookup, "anchor").withColumn("own", own).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                 .select(F.col("anchor").bitwiseOR(F.shiftleft(F.col("part").cast("long"), ANCHOR_BITS)).alias("anchor"), "fp",
                         (F.col("home") & (F.col("part") == F.col("own"))).alias("home")))
        spread = spread.join(lookup.select("anchor"), "anchor", "left_anti").unionByName(dealt)
    return spread.repartition("anchor").sortWithinPartitions("anchor", F.desc("home")).mapInArrow(links, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, fp, group, component)`` for every row: its content key, fingerprint, the group it is linked with
    however indirectly (named by one of its fingerprints), and the smallest id of that group."""
    rows = stage(docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), fingerprint(F.col(text_col)).alias("fp")),
                 "fingerprints")
    prints = stage(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    classes = components(link_fingerprints(prints)).withColumnRenamed("node", "fp").withColumnRenamed("component", "group")
    named = prints.join(classes, "fp").select("fp", "group", "first")
    lowest = named.groupBy("group").agg(F.min("first").alias("lowest"))
    linked = named.join(lowest, "group").select("fp", "group", "lowest")
    by_print = stage(prints.join(linked, "fp", "left").select(
        "fp", F.coalesce("group", "fp").alias("group"), F.coalesce("lowest", "first").alias("component")), "classes")
    return rows.join(by_print, "fp").select("id", "key", "fp", "group", "component")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay when each group keeps the row of its smallest id (of equal ids and texts one row)."""
    found = near_duplicates(docs, id_col, text_col)
    kept = found.groupBy("group").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("low")).select(F.col("low.key").alias("key"))
    name = free_name(docs, "key")
    keyed = docs.withColumn(name, row_key(id_col, text_col))
    return keyed.join(kept.withColumnRenamed("key", name), name, "left_semi").dropDuplicates([name]).drop(name)


def hexadecimal(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
