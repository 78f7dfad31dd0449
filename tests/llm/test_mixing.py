"""Mixing: targets, draws, permutations, and what is taken of each document."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from delayworks.llm import mixing, queries
from tests.llm import frames


def plain_targets(sizes):
    """Share by weight step by step; whoever is above twice its size stops there."""
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    out, left, open_ = {}, 1.5 * sum(sizes), set(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if weights[i] * unit > 2 * sizes[i]}
        if not over:
            out |= {i: weights[i] * unit for i in open_}
            break
        out |= {i: 2.0 * sizes[i] for i in over}
        left -= sum(2 * sizes[i] for i in over)
        open_ -= over
    return [out[i] for i in range(len(sizes))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=8))
def test_targets(sizes):
    got = mixing.targets([(str(i), n) for i, n in enumerate(sizes)])
    assert np.allclose(got, plain_targets(sizes)) and abs(sum(got) - 1.5 * sum(sizes)) < 1e-6 * max(1, sum(sizes))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=5), st.integers(1, 60))
def test_shards_share_out_all_slots(slots, size):
    total = sum(slots)
    shards = max(1, -(-total // size))
    runs = [mixing.shard_runs(k, shards, slots, size) for k in range(shards)]
    for s, n in enumerate(slots):
        at = 0
        for run in runs:
            assert run[s][0] == at
            at += run[s][1]
        assert at == n
    assert [sum(c for _, c in run) for run in runs] == [min(size, total - k * size) for k in range(shards)]


def test_draws_look_multinomial():
    slots = [6000, 3000, 1000]
    counts = np.array([[c for _, c in mixing.shard_runs(k, 100, slots, 100, seed=s)] for s in range(3) for k in range(100)])
    assert np.abs(counts.mean(axis=0) - [60, 30, 10]).max() < 1e-9
    assert np.allclose(counts.std(axis=0), [24 ** .5, 21 ** .5, 9 ** .5], rtol=0.2)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 1000))
def test_permutation(n, key):
    assert sorted(mixing.permute(np.arange(n), n, key).tolist()) == list(range(n))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_whole_table(spark, small):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    one, two = (sorted(map(tuple, queries.QUERIES["op8_mixing"](spark, small).collect())) for _ in range(2))
    assert one == two and len(one) == len(docs)
    sources = sorted({r.source for r in docs.values()}, key=lambda s: (s is None, s))
    size = {s: sum(len(words(r.text)) for r in docs.values() if r.source == s) for s in sources}
    target = dict(zip(sources, plain_targets([size[s] for s in sources])))
    taken = dict.fromkeys(sources, 0)
    for i, n, source_size, goal, took in one:
        s = docs[i].source
        assert n == len(words(docs[i].text)) and source_size == size[s] and abs(goal - target[s]) < 1e-6 and took <= 2 * n
        taken[s] += took
    assert all(abs(taken[s] - target[s]) <= 2 * mixing.BLOCK_WORDS for s in sources)


def test_awkward_rows_and_texts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SALT_ROWS", 9)
    docs = frames.documents(spark)
    mixed = mixing.mix(docs, block=16, shard_slots=50)
    rows = mixing.taken_words(mixed).collect()
    assert len(rows) == docs.count()
    assert all(r.taken <= 2 * r.size for r in rows) and {r.taken for r in rows if r.size == 0} == {0}
    out = mixing.texts(docs, mixed)
    assert out.columns == docs.columns
    got = out.collect()
    assert sum(len(words(r.text)) for r in got) == sum(r.taken for r in rows)
    whole = {}
    for r in docs.collect():
        whole.setdefault(r.doc_id, []).append(words(r.text))
    for r in got:
        assert any(set(words(r.text)) <= set(w) for w in whole[r.doc_id])
    assert mixing.taken_words(mixing.mix(docs.where("false"))).count() == 0
    assert mixing.texts(docs.where("false"), mixing.mix(docs.where("false"))).count() == 0


def test_cut_words_keeps_white_space():
    pattern = re.compile(mixing.WORD)
    assert mixing.cut_words("  a b\n\tc  d ", [(1, 2)], pattern) == "b\n\tc  "
    assert mixing.cut_words("  a b\n\tc  d ", [(0, 1), (3, 1)], pattern) == "a d "
