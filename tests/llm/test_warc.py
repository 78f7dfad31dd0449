"""WARC archives: standard readability, byte ranges of any size, revisits."""

import base64
import glob
import gzip
import hashlib
import io
import random

import pytest

from delayworks.llm import queries, warc
from delayworks.sources.staging import scratch_path


def wanted(rows):
    out, rest = [], {}
    for i, html in rows:
        payload = (html or "").encode()
        rest.setdefault((payload if i is not None else object()), []).append(i)
    for payload, ids in rest.items():
        top = None if ids[0] is None else max(ids)
        body = payload if isinstance(payload, bytes) else None
        for k, i in enumerate(sorted(ids, key=lambda x: (x is None, x), reverse=True)):
            out.append((i, body, "response" if k == 0 else "revisit", None if k == 0 else top))
    return out


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


AWKWARD = [(1, "http://a/", "<p>same</p>"), (2, "http://b/", "<p>same</p>"), (2, "http://c/", "<p>same</p>"), (3, None, None), (4, "x\r\ny", ""),
           (5, "http://e/", "é" * 10), (6, "http://f/", "\x1f\x8b\x08 WARC/1.1\r\n\r\n"), (7, "http://g/", "".join(random.Random(1).choices("abcdef <>", k=300_000)))]


@pytest.fixture(scope="module")
def archive(spark):
    path = scratch_path(spark, "warc-test")
    df = spark.createDataFrame(AWKWARD, "page_id long, url string, html string").selectExpr("*", "'x' AS id", "'y' AS digest", "1 AS rows")
    warc.write(warc.plan(df).coalesce(2), path)
    return path


@pytest.mark.parametrize("size", [1 << 23, 30_000, 4_999])
def test_any_range_size_reads_every_record_once(size, spark, archive):
    got = warc.read(spark, archive, range_bytes=size).collect()
    want = wanted([(i, h) for i, _, h in AWKWARD])
    key = lambda r: (r[0], r[2])
    assert sorted(((r.id, digest(b), r.record_type, r.refers_to, len(b)) for r in got for b in [next(w[1] for w in want if w[0] == r.id)]), key=key) == \
        sorted(((r.id, r.digest, r.record_type, r.refers_to, r.payload_bytes) for r in got), key=key)
    assert sorted((r.id, r.record_type, r.refers_to) for r in got if r.id) == sorted((i, t, f) for i, _, t, f in want) or \
        sorted(map(str, ((r.id, r.record_type, r.refers_to) for r in got))) == sorted(map(str, ((i, t, f) for i, _, t, f in want)))
    assert all(r.payload == next(w[1] for w in want if w[0] == r.id) for r in got if r.record_type == "response")


def test_plain_gzip_readers_read_the_archives(archive):
    folder = archive.removeprefix("file:")
    text = b"".join(gzip.open(f).read() for f in glob.glob(f"{folder}/part-*"))
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(AWKWARD)


def test_false_magic_inside_a_member_is_no_record():
    inner = warc.record_bytes(9, "u", b"inner", digest(b"inner"), None)
    record = warc.record_bytes(1, "u", inner * 50, digest(inner * 50), None, level=0)  # stored: members lie bare inside
    data = record + b"\0" + warc.record_bytes(2, "v", b"two", digest(b"two"), None)
    whole = [warc.parse(r)["id"] for _, r in warc.scan(io.BytesIO(data), 0, len(data), len(data))]
    assert whole == [1, 2]
    junk = b"\x1f\x8b\x08" * 20 + data[:40] + data[len(record):]
    assert [warc.parse(r)["id"] for _, r in warc.scan(io.BytesIO(junk), 0, len(junk), len(junk))] == [2]


def test_empty_table_and_least_size(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-empty")
    warc.write(warc.plan(df), path)
    assert warc.read(spark, path).count() == 0
    two = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], df.schema)
    refers = {r.id: r.refers_to for r in warc.plan(two, least=3).collect()}
    assert refers == {1: None, 2: None, 3: 4, 4: None}


def test_whole_table(spark, small):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op6_warc"](spark, small).collect())
    assert got == sorted((i, len(b), digest(b), t, f) for i, b, t, f in wanted(rows))
