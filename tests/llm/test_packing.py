"""Packing: encoding, the cutting-stock plan and the placement."""

import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from delayworks.llm import packing, queries
from tests.llm import frames

PATH = public_tokenizers.path(packing.VOCABULARY)
PLAIN = Tokenizer.from_file(PATH)  # as the library has it by default


def ids_of(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aAbZéÉßµªº²½¾ÿ'’stdvelrm \t\n\x0b\x1c\x85\xa01_.,!<|>endoftxİΣσ中́😀"), max_size=30))
def test_looked_up_words_give_the_ids_of_the_whole_text(text):
    raw = packing.encoder(PATH).encode([text])[0]
    assert np.frombuffer(raw, "<u4").tolist() == ids_of(text)[:-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "a", " ", "ß", "İ", "中", "endoftext", "'s"]), max_size=8).map("".join))
def test_reserved_tokens_keep_their_ids(text):
    assert np.frombuffer(packing.encoder(PATH).encode([text])[0], "<u4").tolist() == ids_of(text)[:-1]


def test_known_ids_of_reserved_tokens():
    assert np.frombuffer(packing.encoder(PATH).encode(["<|endoftext|> a"])[0], "<u4").tolist() == [49407, 320]


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 300), min_size=1, max_size=20))
def test_plan_places_every_rank_once_within_capacity(histogram):
    planned = packing.plan(histogram, 32)
    filled = np.zeros(planned.sequences, int)
    slots = set()
    for c, n in histogram.items():
        runs = sorted(planned.runs[c])
        for rank in range(n):
            first, base, per, at = max(r for r in runs if r[0] <= rank)
            sequence, slot = base + (rank - first) // per, at + (rank - first) % per
            assert (sequence, slot) not in slots
            slots.add((sequence, slot))
            filled[sequence] += c
    assert filled.max() <= 32 and filled.min() > 0
    bound = -(-sum(c * n for c, n in histogram.items()) // 32)
    assert planned.sequences <= first_fit_decreasing(histogram, 32) + 1 and planned.sequences >= bound


def first_fit_decreasing(histogram, capacity):
    room = []
    for c in sorted(histogram, reverse=True):
        for _ in range(histogram[c]):
            i = next((i for i, r in enumerate(room) if r >= c), None)
            if i is None:
                room.append(capacity - c)
            else:
                room[i] -= c
    return len(room)


def test_linear_program_meets_its_bound():
    sizes, counts = np.array([3, 5, 7]), np.array([100.0, 60.0, 40.0])
    found = packing.solve(sizes, counts, 10)
    assert np.allclose(sum(p * x for p, x in found), counts)
    assert abs(sum(x for _, x in found) - 90) < 1e-6  # 40 x (7 + 3), 30 x (5 + 5), 20 x (3 + 3 + 3)


def check_placement(rows, length):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    assert sorted(by) == list(range(len(by)))
    for parts in by.values():
        upto = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == upto
            upto += r.length
        assert upto <= length
    return len(by)


def test_whole_table(spark, small):
    rows = queries.QUERIES["op3_packing"](spark, small).collect()
    sequences = check_placement(rows, packing.LENGTH)
    texts = {r.doc_id: ids_of(r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for i, ids in texts.items():
        parts = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert sum(r.length for r in parts) == len(ids) and [r.start for r in parts] == list(range(0, len(ids), packing.LENGTH))
        for r in parts:
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
    total = sum(map(len, texts.values()))
    assert total / (sequences * packing.LENGTH) > 0.95


def test_awkward_rows_and_hot_lengths(spark, monkeypatch):
    monkeypatch.setattr(packing, "SALT_ROWS", 7)
    docs = frames.documents(spark)
    pieces = packing.stored_pieces(docs)
    rows = packing.place(pieces.drop("ids")).collect()
    check_placement(rows, packing.LENGTH)
    texts = [r.text for r in docs.collect()]
    assert sum(r.length for r in rows) == sum(len(ids_of(t)) for t in texts)
    assert sum(r.start == 0 for r in rows) == len(texts)
    assert packing.place(packing.stored_pieces(docs.where("false")).drop("ids")).count() == 0


def test_sequences_hold_the_ids_in_order(spark):
    docs = spark.createDataFrame([(i, "word " * random.Random(i).randint(0, 3000)) for i in range(12)], "doc_id long, text string")
    placed = packing.place(packing.stored_pieces(docs))
    whole = {r.sequence_id: r for r in packing.sequences(placed).collect()}
    assert all(len(r.ids) // 4 == packing.LENGTH or r.used & (r.used - 1) == 0 for r in whole.values())
    for r in placed.collect():
        assert bytes(whole[r.sequence_id].ids[4 * r.offset:4 * (r.offset + r.length)]) == bytes(r.ids)
    assert placed.select(F.sum("length")).first()[0] == sum(r.used for r in whole.values())


def test_inverse_by_elimination():
    rng = np.random.default_rng(3)
    for n in (1, 2, 40):
        m = rng.integers(0, 5, (n, n)) + np.eye(n) * rng.integers(1, 4, n)[:, None]
        m[[0, -1]] = m[[-1, 0]]
        assert np.allclose(packing.inverted(m) @ m, np.eye(n))


def test_a_large_plan_ends_in_a_process_that_has_forked(spark):
    """The table of scale 0.1, with many classes: encoding and plan end within five minutes."""
    import signal

    def late(*_):
        raise TimeoutError("packing did not end")

    signal.signal(signal.SIGALRM, late)
    signal.alarm(300)
    try:
        placed = queries.QUERIES["op3_packing"](spark, "/root/testdata/sf0.1").groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(
            F.max("n"), F.sum("n"), F.count("*")).first()
    finally:
        signal.alarm(0)
    assert placed[0] <= 4096 and placed[1] / (4096 * placed[2]) > 0.97
