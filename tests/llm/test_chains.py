"""The two-label chain, the quality and the toxicity operator."""

import itertools
import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from delayworks.llm import crf, quality, queries, toxicity
from tests.llm import frames


def brute_marginals(logits, starts, start, trans):
    """Sum over all labellings of every sequence."""
    out = []
    edges = [*np.flatnonzero(starts).tolist(), len(logits)]
    for a, b in zip(edges, edges[1:]):
        total, hot = 0.0, np.zeros(b - a)
        for ys in itertools.product((0, 1), repeat=b - a):
            s = start * ys[0] + sum(logits[a + i] * y for i, y in enumerate(ys))
            s += sum(trans[p, q] for p, q in zip(ys, ys[1:]))
            total += math.exp(s)
            hot += math.exp(s) * np.array(ys)
        out.extend(hot / total)
    return np.array(out)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 7), min_size=1, max_size=5), st.integers(0, 10_000))
def test_marginals_match_enumeration(lengths, seed):
    rng = np.random.default_rng(seed)
    n = sum(lengths)
    starts = np.zeros(n, bool)
    starts[np.cumsum([0, *lengths[:-1]])] = True
    logits, start, trans = rng.normal(0, 3, n), rng.normal(), rng.normal(0, 2, (2, 2))
    ahead, behind = crf.messages(logits, starts, start, trans)
    got = ahead * behind / (1 + ahead * behind)
    assert np.allclose(got, brute_marginals(logits, starts, start, trans), atol=1e-9)


def test_a_long_chain_equals_its_parts():
    rng = np.random.default_rng(0)
    logits, trans = rng.normal(0, 2, 5000), np.array([[0.5, -1.0], [-0.7, 0.9]])
    starts = rng.random(5000) < 0.01
    starts[0] = True
    whole = crf.messages(logits, starts, 0.3, trans)
    edges = [*np.flatnonzero(starts).tolist(), 5000]
    for a, b in zip(edges, edges[1:]):
        part = crf.messages(logits[a:b], starts[a:b], 0.3, trans)
        assert np.allclose(whole[0][a:b], part[0]) and np.allclose(whole[1][a:b], part[1])


def test_fit_recovers_labels_that_need_neighbours():
    rng = np.random.default_rng(1)
    y, x = [], []
    for _ in range(300):
        state = int(rng.random() < 0.5)
        for _ in range(20):
            state = state if rng.random() < 0.9 else 1 - state
            y.append(state)
            x.append(state if rng.random() < 0.7 else 1 - state)
    y, x, starts = np.array(y), np.array(x), np.arange(len(y)) % 20 == 0
    chain = crf.fit([x], [2], y, starts)
    smoothed = ((chain.marginals([x], starts) > 0.5) == y).mean()
    assert smoothed > (x == y).mean() + 0.08


@pytest.mark.parametrize("name, column, threshold, least", [("op1_quality", "quality", 0.5, 0.95), ("op2_toxicity", "toxic", 0.7, 0.93)])
def test_held_out_accuracy(name, column, threshold, least, spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES[name](spark, folder)
    known = {r.doc_id: r[column] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = rows.collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in got)
    held = [(known[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in known]
    assert sum(a == b for a, b in held) / len(held) >= least


@pytest.mark.parametrize("fit, column", [(quality.fit, "quality"), (toxicity.fit, "toxic")])
def test_scores_do_not_depend_on_held_out_labels(fit, column, spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn(column, F.when(held, 1 - F.col(column)).otherwise(F.col(column)))
    score = quality.score if column == "quality" else lambda m, c: toxicity.tag(m, c)["score"]
    one, two = (docs.select("doc_id", score(fit(docs, x), "text").alias("s")).collect() for x in (labels, turned))
    assert sorted(one) == sorted(two)


def test_awkward_rows_are_scored(spark):
    docs = frames.documents(spark)
    known = frames.labels(spark, [(i, i % 2, int(i % 3 == 0)) for i in range(100, 160)] + [(100, None, None), (None, 1, 1), (101, 0, 1), (101, 1, 0)])
    q, t = quality.fit(docs, known), toxicity.fit(docs, known)
    rows = docs.select("doc_id", "text", quality.score(q, "text").alias("q"), toxicity.tag(t, "text").alias("t")).collect()
    assert len(rows) == docs.count() and all(0 <= r.q <= 1 and 0 <= r.t.score <= 1 for r in rows)
    same = [r for r in rows if r.doc_id == 7 and r.text == "one two three"]
    assert len({(r.q, r.t.score) for r in same}) == 1
    none = [r for r in rows if not (r.text or "").strip()]
    assert len(none) == 3 and none[0].t.score == none[1].t.score == none[2].t.score
    assert quality.keep_good(docs, q).columns == docs.columns == toxicity.keep_clean(docs, t).columns


def test_empty_tables_and_missing_labels(spark):
    docs, none = frames.documents(spark), frames.labels(spark, [])
    q, t = quality.fit(docs, none), toxicity.fit(docs, none)
    rows = docs.select(quality.score(q, "text").alias("q"), toxicity.tag(t, "text")["score"].alias("t")).collect()
    assert {(round(r.q, 6), r.t) for r in rows} == {(0.5, 0.5)}
    empty = docs.where("false")
    assert quality.keep_good(empty, quality.fit(empty, none)).count() == 0
    assert toxicity.keep_clean(empty, toxicity.fit(empty, none)).count() == 0


def test_toxic_spans_point_at_the_words():
    rng = np.random.default_rng(2)
    plain = [f"word{i}" for i in range(300)]
    texts, y = [], []
    for i in range(300):
        words = rng.choice(plain, 30).tolist()
        if i % 4 == 0:
            words[int(rng.integers(30))] = "grubdolt"
        texts.append(" ".join(words))
        y.append(int(i % 4 == 0))
    model = toxicity.train(texts, np.array(y))
    text = "Some Word1, then GRUBDOLT! and word2"
    scores, p, _ = model.scores([toxicity.tokens_of(text), toxicity.tokens_of("word1 word2")])
    spans = model.spans(text, p[:6])
    assert [text[s["start"]:s["end"]] for s in spans] == ["GRUBDOLT"] and scores[0] > 0.7 > 0.3 > scores[1]


def test_line_marginals_tell_lines_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = quality.fit(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    lines = quality.line_marginals(model, "Et la queaux de la mention. Le re.\nAN!! THE!! THE!! ONBLETI!! ON!! ED!! AN!! THE!! OF!! RE!!")
    assert lines["good"][0] > lines["good"][1]


def plain_marginals(chain, slots, n):
    """Forward-backward of one sequence, step by step with sums over both labels."""
    def sums(values):
        top = max(values)
        return top + np.log(sum(np.exp(v - top) for v in values))

    evidence = [(0.0, chain.bias + sum(w[s[i]] for w, s in zip(chain.emission, slots))) for i in range(n)]
    ahead = [[evidence[0][0], evidence[0][1] + chain.start]]
    for i in range(1, n):
        ahead.append([evidence[i][j] + sums([ahead[-1][k] + chain.trans[k, j] for k in (0, 1)]) for j in (0, 1)])
    behind = [[0.0, 0.0]]
    for i in range(n - 2, -1, -1):
        behind.append([sums([chain.trans[j, k] + evidence[i + 1][k] + behind[-1][k] for k in (0, 1)]) for j in (0, 1)])
    behind.reverse()
    return [1 / (1 + np.exp(a[0] + b[0] - a[1] - b[1])) for a, b in zip(ahead, behind)]


def calibrated(model, odds):
    return 1 / (1 + np.exp(-(model.slope * odds + model.shift)))


def test_quality_scores_equal_a_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    model = quality.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    got = {r.doc_id: r.score for r in queries.QUERIES["op1_quality"](spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").where("length(text) < 1500").collect():
        own = [tuple(int(np.searchsorted(edges, v)) for edges, v in zip(quality.MEASURES, m)) for m in quality.measures(r.text.encode().split(b"\n"))]
        n, none = len(own), tuple(quality.BINS)
        slots = list(zip(*own)) + list(zip(*[none, *own[:-1]])) + list(zip(*[*own[1:], none]))
        weight = [len(line.encode()) + 1 for line in r.text.split("\n")]
        good = sum(p * w for p, w in zip(plain_marginals(model.chain, slots, n), weight)) / sum(weight)
        good = min(max(good, 1e-4), 1 - 1e-4)
        assert abs(got[r.doc_id] - calibrated(model, np.log(good / (1 - good)))) < 1e-6


def test_toxicity_scores_equal_a_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    model = toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    got = {r.doc_id: r.score for r in queries.QUERIES["op2_toxicity"](spark, folder).collect()}
    part = lambda text: 1 + zlib.crc32(text.encode()) % (toxicity.HASH_SIZE - 1) if text else 0
    for r in spark.read.parquet(f"{folder}/documents.parquet").where("length(text) < 1500").collect():
        words = [w.lower() for w in toxicity.TOKEN.findall(r.text)]
        if not words:
            continue
        entry = [next((model.vocabulary[u] for u in toxicity.units_of(w) if u in model.vocabulary), 0) for w in words]
        edge = len(model.vocabulary) + 1
        slots = [entry, [edge, *entry[:-1]], [*entry[1:], edge], *([part(w[:n] if len(w) > n else "") for w in words] for n in toxicity.BEGINNINGS),
                 [part(w[-toxicity.ENDING:] if len(w) > toxicity.ENDING else "") for w in words], [part(w) for w in words],
                 [min(len(w), 15) + 16 * (not w.isalpha()) + 32 * (not w.isascii()) for w in words]]
        top = min(max(max(plain_marginals(model.chain, slots, len(words))), 1e-6), 1 - 1e-6)
        assert abs(got[r.doc_id] - calibrated(model, np.log(top / (1 - top)))) < 1e-6


def test_held_out_toxic_documents_are_found(spark):
    """At this size about one toxic label in eight stands on a text with no trace of it, so 0.85 is nearly all of the rest."""
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet").where("toxic is not null")
    held = docs.join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    rows = held.select("toxic", toxicity.tag(toxicity.fit(docs, labels), "text")["score"].alias("score")).collect()
    found = [r.score >= toxicity.THRESHOLD for r in rows if r.toxic]
    wrong = [r.score >= toxicity.THRESHOLD for r in rows if not r.toxic]
    assert sum(found) / len(found) >= 0.85 and sum(wrong) / len(wrong) <= 0.02
