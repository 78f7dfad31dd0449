"""WARC archives: a committed writer and a splittable reader.

Writing: each record is a gzip member of its own. The members are the rows of a text table whose row separator is a NUL
byte, so Spark's own commit protocol writes the archives to any store it knows, and a lost task leaves nothing behind; a
zero byte between members is the padding that gzip readers skip.

Reading: a table of byte ranges is dealt to tasks. A task scans its range for the gzip magic, takes a place as a record
only if a whole member decodes there and begins with a WARC header, and owns the records that start inside its range; it
reads past the end of the range to finish the last of them. Places inside a member that it has decoded are skipped, and a
range that starts inside a member never takes compressed bytes for one, because they would have to inflate to a header.

Equal payloads of at least ``least`` bytes are stored once: the record with the largest id is the response, the others
revisit it and carry its digest, length and id. Records without an id are always responses.

Defined cases: null html is an empty payload, a null url an empty target; repeated ids: of equal payloads only one row of
the largest id is the response, its twins revisit it; an empty table writes and reads no record; only the named columns
are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from delayworks.llm.common import stage


#: Payloads of this size and more are compared; nothing is too small here.
LEAST = 0
LEVEL = 1
#: Bytes of an archive that one row of the range table covers.
RANGE_BYTES = 8 << 20
#: Tasks that read archives; beyond so many ranges a task reads several, one after the other.
MOST_TASKS = 20_000
READ_BYTES = 1 << 20
MAGIC = b"\x1f\x8b\x08"
DATE = "1970-01-01T00:00:00Z"
HEADER_END = b"\r\n\r\n"


def record_bytes(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, level: int = LEVEL) -> bytes:
    """One WARC/1.1 record as a gzip member. A revisit has the full payload's digest and length but no payload."""
    revisit = refers_to is not None
    block = b"" if revisit else payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))), ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields[4:4] = [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                       ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + HEADER_END, level, mtime=0)


def clean_url(url: str | None) -> str:
    """A header value is one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def plan(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> DataFrame:
    """``(id, url, html, refers_to)``: the response that a record revisits, null for a response.

    Equal payloads are found by their SHA-1: narrow counts per digest and id, then the largest id per digest, joined back
    once. Only where a response's id is repeated with the same payload are its rows ranked, so that one stays.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html"))
    marked = rows.withColumn("digest", F.when((F.octet_length("html") >= least) & F.col("id").isNotNull(),
                                              F.unhex(F.sha1(F.col("html").cast("binary")))))
    counted = marked.where("digest is not null").groupBy("digest", "id").agg(F.count("*").alias("n"))
    shared = stage(counted.groupBy("digest").agg(F.max("id").alias("response"), F.sum("n").alias("rows"), F.max_by("n", "id").alias("twins"))
                   .where("rows > 1").select("digest", "response", (F.col("twins") > 1).alias("tied")), "shared-payloads")
    linked = marked.join(shared, "digest", "left")
    fields = ["id", "url", "html"]
    other = F.when(F.col("id") != F.col("response"), F.col("response")).alias("refers_to")
    if shared.where("tied").isEmpty():
        return linked.select(*fields, other)
    response = F.coalesce(F.col("tied") & (F.col("id") == F.col("response")), F.lit(False))
    one = Window.partitionBy("digest").orderBy(F.asc_nulls_first("url"))
    ranked = linked.where(response).withColumn("place", F.row_number().over(one))
    return (linked.where(~response).select(*fields, other)
            .unionAll(ranked.select(*fields, F.when(F.col("place") > 1, F.col("response")).alias("refers_to"))))


def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for page_id, url, html, refers_to in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "html", "refers_to"))):
            payload = html.encode("utf-8", "replace")
            out.append(record_bytes(page_id, clean_url(url), payload, sha1_base32(payload), refers_to))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write(records: DataFrame, path: str) -> None:
    """Archives of ``records`` (see :func:`plan`) under ``path``, as many as the frame has partitions."""
    members = records.select("id", "url", "html", "refers_to").mapInArrow(encode, "member binary")
    (members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").option("compression", "none").text(path))


def ranges(spark: SparkSession, path: str, size: int = RANGE_BYTES) -> DataFrame:
    """``(path, length, start, end)`` byte ranges of all files under ``path``; the listing is Spark's, the bytes are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    cut = files.where("length > 0").withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))))
    cut = cut.withColumn("end", F.least(F.col("start") + size, F.col("length")))
    # a number of its own: the table is tiny, and run-time merging by bytes would put all ranges into one task
    return cut.repartition(max(1, min(MOST_TASKS, cut.count())))


def opened(path: str):
    """A seekable file of the shared store: a plain path, or any scheme Arrow has a filesystem for."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path) if parts.scheme else path, "rb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


class View:
    """A forward-moving view of a file: bytes by absolute offset, read in pieces and dropped when passed."""

    def __init__(self, file, start: int, length: int):
        self.file, self.base, self.data, self.length = file, start, b"", length
        file.seek(start)

    def fill(self, upto: int) -> None:
        while self.base + len(self.data) < min(upto, self.length):
            more = self.file.read(READ_BYTES)
            if not more:
                break
            self.data += more

    def drop(self, before: int) -> None:
        if before - self.base > READ_BYTES:
            self.data, self.base = self.data[before - self.base:], before


def member(view: View, at: int) -> tuple[bytes, int] | None:
    """The member that starts at ``at`` and the offset behind it; None unless it decodes whole into a WARC record.

    The first bytes are decoded alone, so a false magic is dropped before its neighbourhood is inflated.
    """
    inflate = zlib.decompressobj(wbits=31)
    out, place = [], at
    try:
        while not inflate.eof:
            view.fill(place + READ_BYTES)
            part = view.data[place - view.base:place - view.base + (512 if place == at else READ_BYTES)]
            if not part:
                return None
            out.append(inflate.decompress(part))
            place += len(part)
            head = out[0][:5] if len(out[0]) >= 5 else b"".join(out)[:5]
            if not b"WARC/".startswith(head) and head != b"WARC/":
                return None
    except zlib.error:
        return None
    return b"".join(out), place - len(inflate.unused_data)


def scan(file, start: int, end: int, length: int) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of every record that starts in [start, end)."""
    view, at = View(file, start, length), start
    while at < end:
        view.fill(at + READ_BYTES)
        found = view.data.find(MAGIC, at - view.base)
        if found < 0:
            at = max(at, view.base + len(view.data) - len(MAGIC) + 1)
            if view.base + len(view.data) >= length:
                return
            view.drop(at)
            continue
        at = view.base + found
        if at >= end:
            return
        decoded = member(view, at)
        if decoded is None:
            at += 1
        else:
            yield at, decoded[0]
            at = decoded[1]
        view.drop(at)


def parse(record: bytes) -> dict:
    head, _, rest = record.partition(HEADER_END)
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    block = rest[:int(fields.get("Content-Length", 0))]
    page = lambda name: int(m[1]) if (m := re.search(r"urn:page:(-?\d+)", fields.get(name, ""))) else None
    return {"id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields.get("WARC-Type"),
            "refers_to": page("WARC-Refers-To"), "digest": fields.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
            "payload_bytes": int(fields.get("X-Payload-Length", len(block))), "payload": block}


FIELDS = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                    ("refers_to", pa.int64()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def scan_ranges(keep_payload: bool):
    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "start", "end"))):
                rows, held = [], 0
                with opened(path) as file:
                    for offset, record in scan(file, start, end, length):
                        row = parse(record)
                        if row["record_type"] == "response" and sha1_base32(row["payload"]) != row["digest"]:
                            raise ValueError(f"{path} at {offset}: the payload does not match its digest")
                        held += len(row["payload"])
                        if not keep_payload:
                            row["payload"] = None
                        rows.append(row | {"path": path, "offset": offset})
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, FIELDS)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, FIELDS)

    return scanned


def read(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, keep_payload: bool = True) -> DataFrame:
    """All records of the archives under ``path``; a revisit has no payload of its own."""
    schema = ("path string, offset long, id long, url string, record_type string, refers_to long, digest string, "
              "payload_bytes long, payload binary")
    return ranges(spark, path, range_bytes).mapInArrow(scan_ranges(keep_payload), schema)
