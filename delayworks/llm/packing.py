"""Packing documents into fixed-length sequences by cutting-stock column generation.

Documents are encoded, ended by one id and cut at the sequence length, so only the last piece of a document is shorter.
Piece lengths are counted in classes of ``WIDTH`` tokens. A linear program over cutting patterns (how many pieces of each
class make a sequence) covers the counts with the fewest sequences: a restricted master problem is solved by the revised
simplex method and a knapsack over the capacity prices new patterns until none improves it. Patterns are used a whole
number of times, the few pieces that rounding leaves over are placed first-fit decreasing. The counts have at most
``length / WIDTH`` rows and so does the program: its size does not depend on the number of documents.

Pieces are ranked within their class, and rank alone names a piece's pattern, sequence and slot. A large class is salted
and ranks come from counts per (class, salt), so a class of any size is never ordered in one task.

Defined cases: a null or empty text is the end id alone; repeated rows and ids are packed separately; a null id is
carried; an empty table gives no sequence. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from delayworks.llm.common import pieces, scratch_path

LENGTH = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
WIDTH = 16
#: Pieces of a class that are ranked together.
SALT_ROWS = 5_000
#: Encoded words remembered per process.
CACHE_WORDS = 1 << 20

# In Latin-1 text, which is composed already and lower-cases letter by letter, the vocabulary's words are these; white
# space between them is dropped.
LETTERS = "a-zªµºß-öø-ÿ"
NUMBERS = "0-9²³¹¼½¾"
BLANKS = "\t-\r \x85\xa0"
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{BLANKS}{LETTERS}{NUMBERS}]+")


class Encoder:
    """Ids of whole texts; words seen before are looked up, new ones are encoded many at a time.

    The vocabulary's reserved tokens keep their ids where a text spells them out, as the library has it by default.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.reserved = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ends = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            ends[i] = token.endswith("</w>")
        self.ends, self.known = ends, {}

    @staticmethod
    def latin(text: str) -> bool:
        """Whether all characters are Latin-1."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return True

    def learn(self, words: list[str]) -> None:
        if len(self.known) + len(words) > CACHE_WORDS:
            self.known.clear()
        for lo in range(0, len(words), 512):
            part = words[lo:lo + 512]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part) or (len(ids) and stops[-1] != len(ids)):  # not one run per word: one by one
                for w in part:
                    self.known[w] = np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
                continue
            raw, at = ids.tobytes(), [0, *(4 * stops).tolist()]
            self.known.update((w, raw[a:b]) for w, a, b in zip(part, at, at[1:]))

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = []
        split: list[list[str] | None] = []
        for t in texts:
            if self.latin(t):
                split.append(None if any(r in t for r in self.reserved) else WORD.findall(t.lower()))
            else:
                split.append(None)
        fresh = {w for words in split if words for w in words}.difference(self.known)
        if len(self.known) + len(fresh) > CACHE_WORDS:
            self.known.clear()
            fresh = {w for words in split if words for w in words}
        if fresh:
            self.learn(list(fresh))
        known = self.known
        for t, words in zip(texts, split):
            if words is None:
                out.append(np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                out.append(b"".join([known[w] for w in words]))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, length: int = LENGTH,
             end_id: int = END_ID) -> DataFrame:
    """``(id, row_hash, start, length, doc_tokens, ids)`` per piece; ``ids`` are little-endian unsigned 32-bit."""
    path = path or public_tokenizers.path(VOCABULARY)
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path).encode, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            at = 0
            for part in pieces(batch.column(1)):
                rows, start, size, total, ids = [], [], [], [], []
                for i, raw in enumerate(encode([t or "" for t in part.to_pylist()])):
                    raw += end
                    n = len(raw) // 4
                    for lo in range(0, n, length):
                        rows.append(at + i)
                        start.append(lo)
                        size.append(min(length, n - lo))
                        total.append(n)
                        ids.append(raw[4 * lo:4 * (lo + length)])
                at += len(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(start, pa.int64()), pa.array(size, pa.int64()),
                     pa.array(total, pa.int64()), pa.array(ids, pa.binary())], ["id", "start", "length", "doc_tokens", "ids"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        cut, f"id {kind}, start long, length long, doc_tokens long, ids binary")


@dataclass
class Plan:
    """Where the pieces of each class go, by rank: runs of ranks that fill the same slots of a pattern's sequences."""

    sequences: int
    runs: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)  # class: (first rank, first sequence, per sequence, first slot)


def solve(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = 20_000) -> list[tuple[np.ndarray, float]]:
    """Patterns (pieces of each class) and how often the linear program uses each."""
    m = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(basis))
    used = inverse @ counts
    for step in range(rounds):
        price = inverse.sum(axis=0)
        pattern = knapsack(sizes, price, capacity)
        if price @ pattern <= 1 + 1e-7:
            break
        way = inverse @ pattern
        room = np.where(way > 1e-9, used / np.where(way > 1e-9, way, 1.0), np.inf)
        out = int(np.argmin(room))
        used = np.maximum(used - room[out] * way, 0.0)
        used[out] = room[out]
        basis[:, out] = pattern
        row = inverse[out] / way[out]
        inverse = inverse - np.outer(way, row)
        inverse[out] = row
        if step % 256 == 255:
            inverse = inverted(basis)
            used = np.maximum(inverse @ counts, 0.0)
    return [(basis[:, i].astype(np.int64), float(used[i])) for i in range(m)]


def inverted(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan inverse. The driver's threaded linear algebra library can wait forever once its process has forked."""
    n = len(matrix)
    both = np.hstack([matrix.astype(float), np.eye(n)])
    for i in range(n):
        pivot = i + int(np.argmax(np.abs(both[i:, i])))
        if pivot != i:
            both[[i, pivot]] = both[[pivot, i]]
        both[i] /= both[i, i]
        factor = both[:, i].copy()
        factor[i] = 0.0
        rows = np.flatnonzero(factor)
        both[rows] -= factor[rows, None] * both[i]
    return both[:, n:]


def knapsack(sizes: np.ndarray, price: np.ndarray, capacity: int) -> np.ndarray:
    """The pattern of the highest price, pieces repeatable, by dynamic programming over the capacity."""
    useful = np.flatnonzero(price > 1e-12)
    s, p = sizes[useful], price[useful]
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(s)
    s, p, useful = s[order], p[order], useful[order]
    fits = np.searchsorted(s, np.arange(capacity + 1), side="right")
    for w in range(1, capacity + 1):
        best[w] = best[w - 1]
        k = fits[w]
        if k:
            value = best[w - s[:k]] + p[:k]
            i = int(np.argmax(value))
            if value[i] > best[w]:
                best[w], choice[w] = value[i], i
    pattern, w = np.zeros(len(sizes)), capacity
    while w > 0:
        if choice[w] < 0:
            w -= 1
        else:
            pattern[useful[choice[w]]] += 1
            w -= s[choice[w]]
    return pattern


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """Sequences for so many pieces of each class (a class is its size in units of the capacity)."""
    out = Plan(0)
    if not histogram:
        return out
    sizes = np.array(sorted(histogram), np.int64)
    left = np.array([histogram[s] for s in sizes.tolist()], np.int64)
    rank = np.zeros(len(sizes), np.int64)

    def use(pattern: np.ndarray, times: int) -> None:
        slot = 0
        for k in np.flatnonzero(pattern)[::-1].tolist():
            per = int(pattern[k])
            out.runs.setdefault(int(sizes[k]), []).append((int(rank[k]), out.sequences, per, slot))
            rank[k] += per * times
            slot += per
        left[:] -= pattern * times
        out.sequences += times

    for pattern, value in solve(sizes, left.astype(float), capacity):
        times = int(value + 1e-6)
        if pattern.any():
            times = min(times, int((left[pattern > 0] // pattern[pattern > 0]).min()))
            if times > 0:
                use(pattern, times)
    while left.any():  # fewer than a pattern's worth for each pattern: bounded by the number of classes
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        for k in range(len(sizes) - 1, -1, -1):
            n = min(int(left[k]), room // int(sizes[k]))
            pattern[k], room = n, room - n * int(sizes[k])
        use(pattern, max(1, int((left[pattern > 0] // pattern[pattern > 0]).min())))
    return out


def assigner(planned: Plan):
    tables = {c: tuple(np.array(x, np.int64) for x in zip(*runs)) for c, runs in planned.runs.items()}

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, rank = batch.column("class").to_numpy(), batch.column("rank").to_numpy()
            sequence, slot = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
            for c in np.unique(kind).tolist():
                rows = np.flatnonzero(kind == c)
                first, base, per, at = tables[c]
                run = np.searchsorted(first, rank[rows], side="right") - 1
                k = rank[rows] - first[run]
                sequence[rows], slot[rows] = base[run] + k // per[run], at[run] + k % per[run]
            kept = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(slot)], [*batch.schema.names, "sequence_id", "slot"])

    return assigned


def place(rows: DataFrame, length: int = LENGTH, width: int = WIDTH) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to piece rows that have ``id, start, length``.

    ``rows`` is read twice and must give the same rows each time: pass a stored table.
    """
    marked = rows.withColumn("class", F.ceil(F.col("length") / width).cast("int"))
    histogram = {r["class"]: r["n"] for r in marked.groupBy("class").agg(F.count("*").alias("n")).collect()}
    planned = plan(histogram, length // width)
    salts = [max(1, -(-histogram.get(c, 0) // SALT_ROWS)) for c in range(length // width + 1)]
    salted = marked.withColumn("salt", F.pmod(F.xxhash64("id", "start"), F.get(F.lit(salts), F.col("class"))).cast("int"))
    before = Window.partitionBy("class").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = (salted.groupBy("class", "salt").agg(F.count("*").alias("n"))
             .select("class", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    order = [F.asc_nulls_first(c) for c in rows.columns if c != "ids"]
    ranked = (salted.withColumn("place", F.row_number().over(Window.partitionBy("class", "salt").orderBy(*order)))
              .join(bases, ["class", "salt"])
              .withColumn("rank", F.col("base") + F.col("place") - 1).select(*rows.columns, "class", "rank"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema)
    assigned = ranked.mapInArrow(assigner(planned), f"{kinds}, sequence_id long, slot long")
    so_far = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return (assigned.withColumn("offset", F.coalesce(F.sum("length").over(so_far), F.lit(0).cast("long")))
            .select(*rows.columns, "sequence_id", "offset"))


def stored_pieces(docs: DataFrame, **options) -> DataFrame:
    """The encoded pieces, written once to the shared folder."""
    path = scratch_path(docs.sparkSession, "pieces")
    tokens = tokenize(docs, **options)
    tokens.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(tokens.schema).parquet(path)


def sequences(placed: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, ids, used)``: the pieces of each sequence joined and padded, unless they fill a power of two."""

    @F.arrow_udf("binary")
    def join(parts: pa.Array) -> pa.Array:
        out = []
        for group in parts.to_pylist():
            raw = b"".join(p["ids"] for p in sorted(group, key=lambda p: p["offset"]))
            n = len(raw) // 4
            out.append(raw if n & (n - 1) == 0 else raw + np.full(length - n, pad_id, "<u4").tobytes())
        return pa.array(out, pa.binary())

    grouped = placed.groupBy("sequence_id").agg(F.collect_list(F.struct("offset", "ids")).alias("parts"), F.sum("length").alias("used"))
    return grouped.select("sequence_id", join("parts").alias("ids"), "used")
