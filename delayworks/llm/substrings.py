"""Substring dedup: words in a window whose word sequence starts anywhere else go.

Every window of ``window`` words is named by its anchor, the leftmost of its ``GRAM``-word phrases with the smallest hash;
equal windows have equal anchors at the same distance. Consecutive windows with one anchor form a stretch.

1. Candidates. Stretches are counted by (anchor, content) and anchors by themselves, both as plain aggregates that collapse
   copies before the shuffle. What is sent back to the documents is not what recurs but what does not: anchors and
   stretches that were counted once name their document in the aggregate, so no hot key is ever joined or gathered.
   A stretch that recurs whole is settled; one with an anchor of its own holds no recurring window; the others are open.
2. Confirmation and location. Open stretches, and one copy of each recurring stretch, are dealt out by anchor. A task
   confirms the windows that recur among the stretches of an anchor, word for word, compiles the confirmed windows of many
   anchors into an Aho-Corasick automaton (a shard of at most about ``SHARD_WORDS`` words) and streams the open stretches
   through it, which locates every occurrence.
3. An anchor with more than ``CROWD`` stretches would be one task: its windows are counted by hash instead, again as an
   aggregate that names the document of what was counted once.
4. Removal. Each text meets its settled and located windows and loses the words they cover.

Window hashes are polynomial over two independent word hashes, 64 bits each.

Defined cases: a null text has no words and keeps nothing; rows that repeat id and text are copies of each other; documents
with fewer words than a window keep all; an empty table gives an empty result; only the named columns are read. All word
hashes of one text are held at once, whatever its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.llm.common import pieces, runs, stage

WINDOW = 35
GRAM = 5
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Words of the stretches that one automaton serves.
SHARD_WORDS = 400_000
#: Stretches of an anchor that one task may take.
CROWD = 2_000
#: Anchors whose stretches are counted by hash are looked up by broadcast up to this many, joined beyond.
BROADCAST_ROWS = 100_000
BLOCK_BYTES = 1 << 20

SETTLED, OPEN, COPY = 0, 1, 2
ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_rng = np.random.default_rng(13)
BYTE_CODES = tuple(_rng.integers(1, 1 << 63, 256, dtype=np.uint64) for _ in range(2))
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words of the texts in a column: where they stand in its bytes, whose they are, and two hashes each."""

    def __init__(self, text: pa.Array, hashed: bool = True):
        text = text.cast(pa.large_string()).fill_null("") if text.null_count else text.cast(pa.large_string())
        edges = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1 + text.offset)[text.offset:]
        raw = text.buffers()[2]
        self.data = np.frombuffer(raw, np.uint8)[edges[0]:edges[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
        self.edges = edges - edges[0]
        word = ~BLANK[self.data]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        inner = self.edges[:-1][self.edges[:-1] < len(self.data)]
        begins[inner] = word[inner]
        self.start = np.flatnonzero(begins)
        ends = word.copy()
        ends[:-1] &= ~word[1:] | begins[1:]
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.edges)  # first word of each text, and the end
        self.hashes = [self._hashed(k) for k in range(2)] if hashed else []

    def _hashed(self, k: int) -> np.ndarray:
        out = np.empty(len(self.start), np.uint64)
        size = self.end - self.start
        powers = _powers(ODD[k], int(size.max(initial=0)))
        lo = 0
        while lo < len(out):  # block by block, so that the arrays per byte stay small
            hi = max(lo + 1, int(np.searchsorted(self.start, self.start[lo] + BLOCK_BYTES)))
            n = size[lo:hi]
            at = np.cumsum(n) - n
            within = np.arange(n.sum()) - np.repeat(at, n)
            values = BYTE_CODES[k][self.data[within + np.repeat(self.start[lo:hi], n)]] * powers[within]
            out[lo:hi] = _mixed(np.add.reduceat(values, at) + n.astype(np.uint64))
            lo = hi
        return out

    def words(self, lo: int, hi: int) -> bytes:
        return self.data[self.start[lo]:self.end[hi - 1]].tobytes()


class Stretches:
    """Stretches of windows with one anchor: ``text``, ``first`` (word of its text), ``windows``, ``anchor``, ``content``."""

    def __init__(self, words: Words, window: int = WINDOW, gram: int = GRAM):
        n = len(words.start)
        span = window - gram + 1  # phrases in a window
        counts = np.diff(words.first)
        if n < window or counts.max(initial=0) < window:
            self.text = self.first = self.windows = np.zeros(0, np.int64)
            self.anchor = self.content = np.zeros(0, np.uint64)
            self.begin = self.text
            return
        phrase = np.zeros(n - gram + 1, np.uint64)
        for j in range(gram):
            phrase = phrase * ODD[0] + words.hashes[0][j:n - gram + 1 + j]
        phrase = _mixed(phrase)
        best, place, held = phrase, np.arange(len(phrase)), 1
        while held < span:  # leftmost smallest phrase of ever longer runs
            step = min(held, span - held)
            left, right = best[:-step], best[step:]
            later = right < left
            place = np.where(later, place[step:], place[:-step])
            best = np.where(later, right, left)
            held += step
        owner = np.repeat(np.arange(len(counts)), counts)
        starts = np.flatnonzero(owner[:n - window + 1] == owner[window - 1:])  # windows within one text
        place = place[starts]
        fresh = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (owner[starts[1:]] != owner[starts[:-1]])])
        self.begin = starts[fresh]
        self.windows = np.diff(np.r_[fresh, len(starts)])
        self.text = owner[self.begin]
        self.first = self.begin - words.first[self.text]
        self.anchor = phrase[place[fresh]]
        self.content = window_hash(words.hashes[1], self.begin, self.windows + window - 1)


def window_hash(codes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of runs of words; runs are taken block by block of the text, by differences of running sums."""
    out, lo = np.empty(len(begin), np.uint64), 0
    longest = int(size.max(initial=0))
    powers = _powers(ODD[1], (1 << 16) + longest)
    inverse = _powers(np.uint64(pow(int(ODD[1]), -1, 1 << 64)), 1 << 16)
    while lo < len(begin):
        base = int(begin[lo])
        hi = int(np.searchsorted(begin, base + (1 << 16)))
        part = codes[base:int((begin[lo:hi] + size[lo:hi]).max())]
        sums = np.r_[np.uint64(0), np.cumsum(part * powers[:len(part)], dtype=np.uint64)]
        b, s = begin[lo:hi] - base, size[lo:hi]
        out[lo:hi] = _mixed((sums[b + s] - sums[b]) * inverse[b] + s.astype(np.uint64))
        lo = hi
    return out


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key, id, text``: rows that share the key are equal in id and text."""
    return docs.select(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("key"), F.col(id_col).alias("id"),
                       F.col(text_col).alias("text"))


def packed(texts: DataFrame) -> DataFrame:
    """The texts squeezed before a shuffle."""
    @F.arrow_udf("binary")
    def squeeze(text: pa.Array) -> pa.Array:
        compressor = zstandard.ZstdCompressor(level=3)
        return pa.array([None if t is None else compressor.compress(t.encode()) for t in text.to_pylist()], pa.binary())

    return texts.withColumn("text", squeeze("text"))


def unpacked(text: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Texts a few megabytes at a time, with the number of the first."""
    open_text, held, size, at = zstandard.ZstdDecompressor().decompress, [], 0, 0
    for i, t in enumerate(text):
        raw = t.as_py()
        held.append(None if raw is None else open_text(raw).decode())
        size += len(held[-1] or "")
        if size >= 2 * BLOCK_BYTES:
            yield at, pa.array(held, pa.large_string())
            held, size, at = [], 0, i + 1
    if held:
        yield at, pa.array(held, pa.large_string())


def once(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """Per key with any: numbers of stretches counted once, of those whose anchor was, and contents of which it holds one copy."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, at = batch.column(0).to_numpy(zero_copy_only=False), 0
            for part in pieces(batch.column(1)):
                s = Stretches(Words(part), window, gram)
                number = np.arange(len(s.text)) - np.searchsorted(s.text, s.text)
                yield pa.RecordBatch.from_arrays([_signed(s.anchor), _signed(s.content), pa.array(keys[at + s.text]), pa.array(number.astype(np.int32))],
                                                 ["anchor", "content", "key", "number"])
                at += len(part)

    found = texts.select("key", "text").mapInArrow(scan, "anchor long, content long, key long, number int")
    held = [F.count("*").alias("n"), F.min("key").alias("key"), F.min("number").alias("number")]
    stretches = found.groupBy("anchor", "content").agg(*held)
    anchors = stretches.groupBy("anchor").agg(F.sum("n").alias("n"), *held[1:]).where("n = 1")
    none = F.lit(None)
    marks = (stretches.select("key", F.when(F.col("n") == 1, F.col("number")).alias("single"), none.cast("int").alias("alone"),
                              F.when(F.col("n") > 1, F.col("content")).alias("copy"))
             .unionAll(anchors.select("key", none.cast("int"), "number", none.cast("long"))))
    return marks.groupBy("key").agg(*[F.collect_list(c).alias(c) for c in ("single", "alone", "copy")])


def stretches_of(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``kind, key, first, windows, anchor, words``: settled runs of windows, open stretches, and copies of recurring ones."""
    marked = packed(texts.select("key", "text")).join(once(texts, window, gram), "key", "left")

    def sort_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_pylist()
            for at, part in unpacked(batch.column("text")):
                w = Words(part)
                s = Stretches(w, window, gram)
                bounds = np.searchsorted(s.text, np.arange(len(part) + 1))
                state = np.full(len(s.text), SETTLED, np.int8)
                copies: list[int] = []
                for i in range(len(part)):
                    lo, hi = bounds[i], bounds[i + 1]
                    if lo == hi:
                        continue
                    single, alone, copy = (batch.column(c)[at + i].values for c in ("single", "alone", "copy"))
                    if single is not None and len(single):
                        state[lo + single.to_numpy()] = OPEN
                    if alone is not None and len(alone):
                        state[lo + alone.to_numpy()] = -1
                    if copy is not None and len(copy):
                        content, place = np.unique(s.content[lo:hi].view(np.int64), return_index=True)
                        copies += (lo + place[np.isin(content, copy.to_numpy())]).tolist()
                settled = np.flatnonzero(state == SETTLED)
                joined = (s.text[settled[1:]] == s.text[settled[:-1]]) & (s.begin[settled[1:]] == s.begin[settled[:-1]] + s.windows[settled[:-1]])
                heads = np.flatnonzero(np.r_[True, ~joined])[:len(settled)]
                total = np.add.reduceat(s.windows[settled], heads) if len(settled) else settled
                settled = settled[heads]
                opened, copies = np.flatnonzero(state == OPEN), np.array(copies, np.int64)
                rows = np.concatenate([settled, opened, copies])
                kind = np.repeat(np.array([SETTLED, OPEN, COPY], np.int8), [len(settled), len(opened), len(copies)])
                windows = np.concatenate([total, s.windows[opened], s.windows[copies]])
                shown = [None] * len(settled) + [w.words(s.begin[r], s.begin[r] + s.windows[r] + window - 1) for r in rows[len(settled):].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind), pa.array([keys[at + t] for t in s.text[rows].tolist()], pa.int64()), pa.array(s.first[rows]), pa.array(windows),
                     _signed(s.anchor[rows]), pa.array(shown, pa.binary())], ["kind", "key", "first", "windows", "anchor", "words"])

    return marked.mapInArrow(sort_out, "kind byte, key long, first long, windows long, anchor long, words binary")


def _coded(words: list[str], known: dict[str, str]) -> str:
    """One character per word; surrogates are left out."""
    for w in words:
        if w not in known:
            n = len(known) + 1
            known[w] = chr(n if n < 0xD800 else n + 0x800)
    return "".join([known[w] for w in words])


def located(shard: list[tuple[int, list[tuple[int, int, int, str]]]], window: int) -> Iterator[tuple[int, int, int]]:
    """``(key, first, windows)`` of the recurring windows in the open stretches of a shard.

    The shard holds, per anchor, stretches ``(kind, key, first, words)``.
    """
    known: dict[str, str] = {}
    streams, confirmed = [], set()
    for _, stretches in shard:
        seen: set[str] = set()
        for kind, key, first, words in stretches:
            coded = _coded(WORD.findall(words), known)
            cut = [coded[i:i + window] for i in range(len(coded) - window + 1)]
            if kind == OPEN:
                streams.append((key, first, coded))
                confirmed.update(c for c in cut if c in seen)
                seen.update(cut)
            else:
                confirmed.update(cut)
    if not confirmed or not streams:
        return
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for phrase in confirmed:
        automaton.add_word(phrase)
    automaton.make_automaton()
    for key, first, coded in streams:
        begin = last = None
        for end, _ in automaton.iter(coded):
            if last is not None and end == last + 1:
                last = end
                continue
            if begin is not None:
                yield key, first + begin - window + 1, last - begin + 1
            begin = last = end
        if begin is not None:
            yield key, first + begin - window + 1, last - begin + 1


def located_in(stretches: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``key, first, windows`` of the recurring windows in open stretches, by automata over the stretches of many anchors."""
    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def output(shard):
            found = list(located(shard, window))
            columns = list(zip(*found)) if found else [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "first", "windows"])

        shard, held = [], 0
        for rows, at in runs(batches, ["anchor"]):
            for lo, hi in zip(at, at[1:]):
                group = rows.slice(lo, hi - lo)
                kinds = group.column("kind").to_pylist()
                if OPEN not in kinds or len(kinds) < 2:
                    continue
                shard.append((group.column("anchor")[0].as_py(), list(zip(
                    kinds, group.column("key").to_pylist(), group.column("first").to_pylist(),
                    [w.decode() for w in group.column("words").to_pylist()]))))
                held += sum(group.column("windows").to_pylist()) + window * len(kinds)
                if held >= shard_words:
                    yield output(shard)
                    shard, held = [], 0
        if shard:
            yield output(shard)

    dealt = stretches.select("anchor", "kind", "key", "first", "windows", "words").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(locate, "key long, first long, windows long")


def counted_in(stretches: DataFrame, window: int = WINDOW) -> DataFrame:
    """``key, first`` of the windows of open stretches that recur nowhere, by counts of their hashes."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = Words(batch.column("words").cast(pa.string()))
            n = batch.column("windows").to_numpy()
            row = np.repeat(np.arange(len(n)), n)
            step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            begin = w.first[:-1][row] + step
            size = np.full(len(row), window)
            yield pa.RecordBatch.from_arrays(
                [batch.column("anchor").take(pa.array(row)), _signed(window_hash(w.hashes[1], begin, size)), _signed(window_hash(w.hashes[0], begin, size)),
                 pa.array(np.where(batch.column("kind").to_numpy()[row] == COPY, 2, 1)), batch.column("key").take(pa.array(row)),
                 pa.array(batch.column("first").to_numpy()[row] + step)], ["anchor", "h", "h2", "n", "key", "first"])

    rows = stretches.select("anchor", "kind", "key", "first", "windows", "words")
    found = rows.mapInArrow(hashes, "anchor long, h long, h2 long, n long, key long, first long")
    return (found.groupBy("anchor", "h", "h2").agg(F.sum("n").alias("n"), F.min("key").alias("key"), F.min("first").alias("first"))
            .where("n = 1").select("key", "first"))


def recurring(texts: DataFrame, window: int = WINDOW, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """``key, plus, minus``: recurring windows of each key as runs (first << 32 | windows), less single ones that do not recur."""
    found = stage(stretches_of(texts, window, gram), "stretches")
    candidates = found.where(F.col("kind") != SETTLED)
    crowded = stage(candidates.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("anchor"), "crowded")
    many = crowded.count()
    run = F.shiftleft(F.col("first"), 32).bitwiseOR(F.col("windows"))
    none = F.lit(None).cast("long")
    settled = found.where(F.col("kind") == SETTLED).select("key", run.alias("plus"), none.alias("minus"))
    if many:
        lookup = F.broadcast(crowded) if many <= BROADCAST_ROWS else crowded
        hot, candidates = candidates.join(lookup, "anchor", "left_semi"), candidates.join(lookup, "anchor", "left_anti")
        settled = (settled.unionAll(hot.where(F.col("kind") == OPEN).select("key", run, none))
                   .unionAll(counted_in(hot, window).select("key", none, "first")))
    ranges = settled.unionAll(located_in(candidates, window).select("key", run, none))
    return ranges.groupBy("key").agg(F.collect_set("plus").alias("plus"), F.collect_set("minus").alias("minus"))


def covered(n: int, plus: np.ndarray, minus: np.ndarray, window: int) -> np.ndarray:
    """Which of a text's words stand in a recurring window."""
    def filled(begin: np.ndarray, size) -> np.ndarray:
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + size, -1)
        return np.cumsum(edge[:-1]) > 0

    recurs = filled(plus >> 32, plus & 0xFFFFFFFF)
    recurs[minus] = False
    return filled(np.flatnonzero(recurs), window)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                    crowd: int = CROWD) -> DataFrame:
    """``id, n_words, n_removed, kept``: each document's words outside recurring windows, joined by one space."""
    texts = keyed(docs, id_col, text_col)
    joined = packed(texts).join(recurring(texts, window, gram, crowd), "key", "left").select("id", "text", "plus", "minus")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(0, np.int64)
        for batch in batches:
            for at, part in unpacked(batch.column("text")):
                totals, removed, kept = [], [], []
                for i, t in enumerate(part.to_pylist()):
                    words = WORD.findall(t or "")
                    plus, minus = (batch.column(c)[at + i].values for c in ("plus", "minus"))
                    gone = 0
                    n = len(words)
                    if plus is not None and len(plus):
                        cover = covered(n, plus.to_numpy(), empty if minus is None else minus.to_numpy(), window)
                        gone = int(cover.sum())
                        words = compress(words, (~cover).tolist())
                    totals.append(n)
                    removed.append(gone)
                    kept.append(" ".join(words))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, len(part)), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                                                  pa.array(kept, pa.string())], ["id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(remove, f"id {docs.schema[id_col].dataType.simpleString()}, n_words long, n_removed long, kept string")
