"""Substring dedup against a plain version: planted passages, copies, periodic texts, crowded anchors, small windows."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from delayworks.llm import substrings
from tests.llm import frames

SCHEMA = "doc_id long, text string"


def plain(rows, window):
    split = [(i, substrings.WORD.findall(t or "")) for i, t in rows]
    count = Counter(tuple(w[k:k + window]) for _, w in split for k in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = {k + j for k in range(len(w) - window + 1) if count[tuple(w[k:k + window])] > 1 for j in range(window)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return Counter(out)


def found(df, **options):
    return Counter(map(tuple, substrings.without_repeats(df, **options).collect()))


def corpus(n=120, seed=3):
    """Random documents of a small vocabulary with shared passages, near copies, copies and repeated lines."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    draw = lambda k: [rng.choice(words) for _ in range(k)]
    passages = [draw(rng.randint(30, 90)) for _ in range(8)]
    rows = []
    for i in range(n):
        w = draw(rng.randint(0, 150))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p) - 20)
            at = rng.randint(0, len(w))
            w[at:at] = p[cut:cut + rng.randint(20, 90)]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w)))
    base = draw(200)
    for i in range(40):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((1000 + i, " ".join(w)))
    rows += [(2000 + i, " ".join(["same"] * n)) for i, n in enumerate([34, 35, 36, 80])]
    rows += [(3000 + i, " ".join(["a", "b", "c"] * 30)) for i in range(2)]
    return rows


@pytest.mark.parametrize("crowd", [2_000, 3, 0])
def test_equals_the_plain_version(spark, crowd):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df, crowd=crowd) == plain(rows, 35)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14).map(" ".join), min_size=1, max_size=8))
def test_small_windows_over_three_words(spark, texts):
    rows = list(enumerate(texts))
    assert found(spark.createDataFrame(rows, SCHEMA), window=5, gram=2, crowd=4) == plain(rows, 5)


def test_awkward_rows(spark):
    df = frames.documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert found(df) == plain(rows, 35)
    assert found(df, window=4, gram=2) == plain(rows, 4)
    assert found(df.limit(0)) == Counter()
    nulls = spark.createDataFrame([(1, None), (None, None)], SCHEMA)
    assert found(nulls) == Counter({(1, 0, 0, ""): 1, (None, 0, 0, ""): 1})


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab\x85\xa0é \t\n\x0b\x0c\r\x1c"), max_size=12)), max_size=6))
def test_words_stand_where_the_pattern_finds_them(texts):
    w = substrings.Words(pa.array([None, *texts], pa.string()).slice(1))
    for i, t in enumerate(texts):
        got = [w.data[a:b].tobytes().decode() for a, b in zip(w.start[w.first[i]:w.first[i + 1]], w.end[w.first[i]:w.first[i + 1]])]
        assert got == substrings.WORD.findall(t or "")
    same = Counter((w.data[a:b].tobytes(), h) for a, b, h in zip(w.start, w.end, w.hashes[0].tolist()))
    assert len(same) == len({x for x, _ in same}) == len({h for _, h in same})


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    text = pa.array([" ".join(f"word{i % 50}" * (i % 7 + 1) for i in range(3000)), "x" * 5000, None], pa.string())
    whole = substrings.Words(text)
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 64)
    parts = substrings.Words(text)
    assert all(np.array_equal(a, b) for a, b in zip(whole.hashes, parts.hashes))


def test_automaton_finds_runs():
    words = [f"w{i}" for i in range(20)]
    shard = [(7, [(substrings.COPY, 0, 0, " ".join(words[5:12])), (substrings.OPEN, 1, 100, " ".join(words)), (substrings.OPEN, 2, 50, "x y z x y z")])]
    assert list(substrings.located(shard, 4)) == [(1, 105, 4)]
