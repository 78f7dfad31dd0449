"""Fill-in-the-middle transformation by secondary sort.

The id's hash picks a document's form and where its text is cut in prefix, middle and suffix. The output is emitted in
pieces of at most ``CHUNK`` units (code points), keyed by document and position in the output; they are repartitioned by
document and sorted within partitions, and each document streams piece by piece into an incremental digest. The reader
knows the output and its form only: it finds the sentinels where they are, across pieces, and keys what stands between them
by its place in the text; the same partitions are sorted anew by that key, without a shuffle, and stream into the digest of
the restored text. No step holds more than a piece of a document; only :func:`outputs` puts whole texts together.

Defined cases: a null text is empty; an empty text, one that holds a sentinel, and a share of all others stay plain; a null
id is hashed as empty digits; repeated rows and ids are separate documents; an empty table gives an empty result; only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 4096
SENTINELS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle"), "plain": ()}
PLACES = {"prefix": 0, "middle": 1, "suffix": 2}
END = 3
PLAIN_FROM, SPM_BELOW = 90, 20
BATCH_BYTES = 4 << 20
META = ("row", "id", "n", "form", "prefix_chars", "middle_chars")


def decided(id_col: str, text_col: str) -> dict[str, Column]:
    """Length, form and cuts of a text, from the text and the hash of its id."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    h = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    n = F.length(text).cast("long")
    holds = F.lit(False)
    for s in SENTINELS.values():
        holds = holds | F.contains(text, F.lit(s))
    plain = (n == 0) | holds | (h[2] % 100 >= PLAIN_FROM)
    form = F.when(plain, "plain").when(h[3] % 100 < SPM_BELOW, "spm").otherwise("psm")
    first, second = F.least(h[0] % (n + 1), h[1] % (n + 1)), F.greatest(h[0] % (n + 1), h[1] % (n + 1))
    return {"text": text, "n": n, "form": form, "prefix_chars": F.when(~plain, first), "middle_chars": F.when(~plain, second - first)}


def output_chunks(text: str, form: str, prefix: int | None, middle: int | None, chunk: int) -> Iterator[str]:
    """The output of a document in order, each piece at most ``chunk`` units besides its sentinel."""
    if form == "plain":
        parts = [("", 0, len(text))]
    else:
        spans = {"prefix": (0, prefix), "middle": (prefix, prefix + middle), "suffix": (prefix + middle, len(text))}
        parts = [(SENTINELS[p], *spans[p]) for p in ORDERS[form]]
    for mark, lo, hi in parts:
        yield mark + text[lo:min(hi, lo + chunk)]
        for at in range(lo + chunk, hi, chunk):
            yield text[at:min(hi, at + chunk)]


class Parser:
    """Tells, piece by piece, which part of the text a document's output belongs to."""

    def __init__(self, form: str):
        self.marks = [(SENTINELS[p], p) for p in ORDERS[form]]
        self.part = "prefix"  # a plain output is all prefix
        self.tail = ""
        self.offset = dict.fromkeys(PLACES, 0)

    def _placed(self, text: str) -> Iterator[tuple[int, int, str]]:
        if text:
            yield PLACES[self.part], self.offset[self.part], text
            self.offset[self.part] += len(text)

    def feed(self, text: str) -> Iterator[tuple[int, int, str]]:
        """``(place, offset, text)`` of what is certain so far."""
        text = self.tail + text
        while self.marks:
            mark, part = self.marks[0]
            at = text.find(mark)
            if at < 0:
                break
            yield from self._placed(text[:at])
            text, self.part = text[at + len(mark):], part
            self.marks.pop(0)
        keep = max(0, len(text) - 2) if self.marks else len(text)
        self.tail = text[keep:]
        yield from self._placed(text[:keep])

    def close(self) -> Iterator[tuple[int, int, str]]:
        yield from self._placed(self.tail)


def restore(output: str, form: str) -> str:
    """The text that an output was made of."""
    parser = Parser(form)
    return "".join(t for _, _, t in sorted([*parser.feed(output), *parser.close()], key=lambda x: x[:2]))


class Sink:
    """Rows to record batches of about ``BATCH_BYTES``."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.held = schema, [], 0

    def add(self, row: dict, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.held += size + 100
        if self.held >= BATCH_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, self.schema)
        self.rows, self.held = [], 0


def _meta(batch: pa.RecordBatch) -> list[pa.Field]:
    return [batch.schema.field(c) for c in META]


def pieces_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``row, id, n, form, prefix_chars, middle_chars, at, piece``: outputs in pieces (zstd), ``at`` numbering a document's."""
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                        *[c.alias(name) for name, c in decided(id_col, text_col).items()])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            sink = Sink(pa.schema([*_meta(batch), ("at", pa.int64()), ("piece", pa.binary())]))
            for r in range(batch.num_rows):  # row by row: one text at a time
                row = {c: batch.column(c)[r].as_py() for c in (*META, "text")}
                text, at = row.pop("text"), 0
                for part in output_chunks(text, row["form"], row["prefix_chars"], row["middle_chars"], chunk):
                    piece = squeeze(part.encode())
                    yield from sink.add({**row, "at": at, "piece": piece}, len(piece))
                    at += 1
            yield from sink.flush()

    kind = docs.schema[id_col].dataType.simpleString()
    return given.mapInArrow(cut, f"row long, id {kind}, n long, form string, prefix_chars long, middle_chars long, at long, piece binary")


def in_order(pieces: DataFrame) -> DataFrame:
    """Whole documents in one partition each, their pieces in the order of the output."""
    return pieces.repartition("row").sortWithinPartitions("row", "at")


def streams(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[bool, tuple, pa.RecordBatch, int]]:
    """Rows of a sorted partition one by one: whether a new document begins, the named values, the batch and the row in it."""
    last = None
    for batch in batches:
        rows = batch.column("row").to_pylist()
        values = [batch.column(c).to_pylist() for c in columns]
        for r, row in enumerate(rows):
            yield row != last, tuple(v[r] for v in values), batch, r
            last = row


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256``, the latter from output and form alone."""
    pieces = in_order(pieces_of(docs, id_col, text_col, chunk))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_piece, sink, digest, parser, meta = zstandard.ZstdDecompressor().decompress, None, None, None, None

        def ended():
            for place, offset, text in parser.close():
                yield {**meta, "place": place, "offset": offset, "part": text.encode(), "output_sha256": None}
            yield {**meta, "place": END, "offset": 0, "part": b"", "output_sha256": digest.hexdigest()}

        for fresh, (piece,), batch, r in streams(batches, ("piece",)):
            if sink is None:
                sink = Sink(pa.schema([*_meta(batch), ("place", pa.int32()), ("offset", pa.int64()), ("part", pa.binary()),
                                       ("output_sha256", pa.string())]))
            if fresh:
                if meta is not None:
                    for row in ended():
                        yield from sink.add(row, len(row["part"]))
                meta = {c: batch.column(c)[r].as_py() for c in META}
                digest, parser = sha256(), Parser(meta["form"])
            raw = open_piece(piece)
            digest.update(raw)
            for place, offset, text in parser.feed(raw.decode()):
                part = text.encode()
                yield from sink.add({**meta, "place": place, "offset": offset, "part": part, "output_sha256": None}, len(part))
        if meta is not None:
            for row in ended():
                yield from sink.add(row, len(row["part"]))
            yield from sink.flush()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, sink = None, None
        for fresh, (place, part), batch, r in streams(batches, ("place", "part")):
            if sink is None:
                sink = Sink(pa.schema([*_meta(batch)[1:], ("output_sha256", pa.string()), ("restored_sha256", pa.string())]))
            if fresh:
                digest = sha256()
            digest.update(part)
            if place == END:
                row = {c: batch.column(c)[r].as_py() for c in (*META[1:], "output_sha256")}
                yield from sink.add({**row, "restored_sha256": digest.hexdigest()}, 200)
        if sink is not None:
            yield from sink.flush()

    kind = docs.schema[id_col].dataType.simpleString()
    meta = f"id {kind}, n long, form string, prefix_chars long, middle_chars long"
    parts = pieces.mapInArrow(read, f"row long, {meta}, place int, offset long, part binary, output_sha256 string")
    return parts.sortWithinPartitions("row", "place", "offset").mapInArrow(join, f"{meta}, output_sha256 string, restored_sha256 string")


def outputs(pieces: DataFrame) -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars, output``: whole output texts, each put together in one task."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_piece, sink, meta, parts = zstandard.ZstdDecompressor().decompress, None, None, []
        for fresh, (piece,), batch, r in streams(batches, ("piece",)):
            if sink is None:
                sink = Sink(pa.schema([*_meta(batch)[1:], ("output", pa.string())]))
            if fresh:
                if meta is not None:
                    yield from sink.add({**meta, "output": b"".join(parts).decode()}, sum(map(len, parts)))
                meta, parts = {c: batch.column(c)[r].as_py() for c in META[1:]}, []
            parts.append(open_piece(piece))
        if meta is not None:
            yield from sink.add({**meta, "output": b"".join(parts).decode()}, 0)
            yield from sink.flush()

    kind = pieces.schema["id"].dataType.simpleString()
    return in_order(pieces).mapInArrow(whole, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
