"""SimHash fingerprints, the covering code and the search."""

import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from delayworks.llm import graph, simhash
from tests.llm import frames


def plain_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    spans = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Smallest index reachable over pairs within three bits."""
    n = len(prints)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aAbB é \t\n\x1c", max_size=40))
def test_fingerprint_matches_its_definition(text):
    assert simhash.fingerprint_of(text) == plain_print(text)


def test_every_word_has_one_home_within_one_bit_and_all_anchors_within_two():
    words = np.random.default_rng(0).integers(0, 1 << 31, 500, dtype=np.uint32)
    home, others = simhash.anchors(words)
    assert (np.bitwise_count(home ^ words) <= 1).all() and (simhash.syndrome(home) == 0).all()
    found = {(i, int(a)) for rows, codes in others for i, a in zip(rows.tolist(), codes.tolist())} | set(enumerate(home.tolist()))
    for i, w in enumerate(words[:40].tolist()):
        near = {w} | {w ^ 1 << a for a in range(31)} | {w ^ 1 << a ^ 1 << b for a in range(31) for b in range(a)}
        near = np.array(sorted(near), np.uint32)
        assert {(i, int(a)) for a in near[simhash.syndrome(near) == 0]} == {f for f in found if f[0] == i}


def test_groups_match_all_pairs(spark):
    rng = random.Random(3)
    prints = []
    for _ in range(40):
        base = rng.getrandbits(64)
        prints.append(base)
        for _ in range(rng.randint(0, 12)):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))  # a walk: chains of links
            prints.append(base)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(5)
    found = {r.node: r.component for r in graph.components(simhash.link_fingerprints(df)).collect()}
    want = plain_groups(prints)
    groups, expected = {}, {}
    for s, w in zip(signed, want):
        groups.setdefault(found.get(s, s), set()).add(s)
        expected.setdefault(w, set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_an_anchor_that_spans_batches_is_compared_whole():
    anchor = np.zeros(3000, np.int64)
    fp = np.arange(3000, dtype=np.int64) << 40
    fp[2999] = fp[0] ^ 1
    import pyarrow as pa

    home = np.ones(3000, bool)
    batches = [pa.RecordBatch.from_arrays([pa.array(anchor[i:i + 100]), pa.array(fp[i:i + 100]), pa.array(home[i:i + 100])],
                                          ["anchor", "fp", "home"]) for i in range(0, 3000, 100)]
    whole = [(int(a), int(b)) for out in simhash.links(iter(batches)) for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist())]
    bits = fp.view(np.uint64)
    root = plain_groups(bits.tolist())
    seen = {int(f): i for i, f in enumerate(fp)}
    joined = list(range(3000))

    def find(i):
        while joined[i] != i:
            i = joined[i]
        return i

    for a, b in whole:
        p, q = find(seen[a]), find(seen[b])
        joined[max(p, q)] = min(p, q)
    assert [find(i) for i in range(3000)] == root


def test_whole_table_against_all_pairs(spark, small):
    from delayworks.llm import queries

    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    prints = [plain_print(r.text) for r in docs]
    want = [(r.doc_id, f"{p:016x}", docs[g].doc_id) for r, p, g in zip(docs, prints, plain_groups(prints))]
    got = queries.QUERIES["op7_simhash"](spark, small).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want


def test_awkward_rows(spark):
    docs = frames.documents(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    zero = {r.component for r in rows if r.fp == 0}
    assert zero == {3}
    assert {r.component for r in rows if r.id is None} == {None}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = {r.group for r in rows}
    assert kept.count() == len(groups) and {r.doc_id for r in kept.collect()} >= {1, 3, None}
    assert simhash.near_duplicates(docs.where("false")).count() == 0 and simhash.one_of_each(docs.where("false")).count() == 0


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    assert {found[i] for i in range(201)} == {0} and {found[1000 + i] for i in range(300)} == {1000} and len(found) == 501


def test_crowded_anchors_are_dealt_out_in_blocks(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    prints = {base ^ (rng.getrandbits(32) << 32) for _ in range(60)} | {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)}
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    groups = lambda block: sorted(map(tuple, graph.components(simhash.link_fingerprints(df, block)).collect()))
    assert groups(2) == groups(7) == groups(simhash.BLOCK) != []
