"""Merkle manifest: against a plain construction, with deep trees, hot groups, nulls and repeated rows."""

from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from delayworks.llm import merkle
from tests.llm import frames

FIELDS = merkle.FIELDS


def shown(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row):
    return sha256("".join(shown(row[f]) for f in FIELDS).encode()).hexdigest()


def tree(leaves, arity):
    """All levels, lowest first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha256("".join(last[i:i + arity]).encode()).hexdigest() for i in range(0, len(last), arity)])
    return levels


def way(levels, i, arity):
    """(slot, run) per level from node ``i`` of the lowest."""
    out = []
    for level in levels[:-1]:
        lo = i - i % arity
        out.append((i - lo, level[lo:lo + arity]))
        i //= arity
    return out


def plain(rows, arity, claim=leaf_of):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[s] = tree([leaf_of(r) for r in groups[s]], arity)
    above = tree([trees[s][-1][0] for s in names], arity)
    root, out = above[-1][0], []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            path = [*way(trees[s], i, arity), *way(above, k, arity)]
            proof = "".join(d for slot, run in path for j, d in enumerate(run) if j != slot)
            now = claim(r)
            for slot, run in path:
                now = sha256("".join([*run[:slot], now, *run[slot + 1:]]).encode()).hexdigest()
            out.append((r["doc_id"], leaf_of(r), trees[s][-1][0], root, sha256(proof.encode()).hexdigest(), now, now == root))
    return Counter(out)


def docs(spark, sizes):
    rows = [(i, f"Text {i} of {s}", "en", s, i) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def found(manifest):
    return Counter(map(tuple, merkle.audit(manifest).collect()))


@pytest.mark.parametrize("arity, band", [(16, 3), (3, 2), (2, 1)])
def test_equals_the_plain_construction(spark, arity, band):
    df = frames.documents(spark)
    assert found(merkle.build(df, arity=arity, band=band)) == plain(df.collect(), arity)


@pytest.mark.parametrize("arity, band", [(3, 2), (16, 1)])
def test_sizes_around_powers_and_a_hot_group(spark, arity, band):
    sizes = {"hot": 700, "one": 1, "é": 3, "z": 4, "9": 9, "10": 10, "27": 27, "81": 81, "82": 82, None: 17, "": 16}
    df = docs(spark, sizes)
    assert found(merkle.build(df, arity=arity, band=band)) == plain(df.collect(), arity)


def test_a_changed_row_fails_and_no_other(spark):
    df = docs(spark, {"a": 40, "b": 5})
    low = F.when(F.col("doc_id") % 7 == 0, F.lower("text")).otherwise(F.col("text"))
    expected = plain(df.collect(), 16, lambda r: leaf_of({**r.asDict(), "text": r["text"].lower() if r["doc_id"] % 7 == 0 else r["text"]}))
    got = found(merkle.build(df, claimed={"text": low}))
    assert got == expected
    assert all(r[-1] == (r[0] % 7 != 0) for r in got)


def test_proofs_verify_alone(spark):
    made = merkle.build(docs(spark, {"a": 300, "b": 20, "c": 1}))
    for r in merkle.proofs(made).collect():
        assert merkle.fold(bytes(r["leaf"]), bytes(r["proof"])) == made.root
        assert merkle.fold(bytes(32), bytes(r["proof"])) != made.root or not r["proof"]


def test_one_row_and_none(spark):
    one = docs(spark, {"a": 1})
    assert found(merkle.build(one)) == plain(one.collect(), 16)
    assert merkle.build(one).root.hex() == leaf_of(one.first())
    empty = merkle.build(docs(spark, {"a": 0}))
    assert empty.root is None and merkle.audit(empty).collect() == [] and merkle.proofs(empty).collect() == []
