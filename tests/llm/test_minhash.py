"""One-permutation MinHash against plain Python on the same hashes, and against true likeness."""

import hashlib
import random

from pyspark.sql import functions as F

from delayworks.llm import minhash, queries
from tests.llm import frames


def shingles(text):
    w = (text or "").split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in queries.QUERIES["op9_minhash"](spark, small).collect()}
    assert len(got) == len(docs)
    prints, errors = {}, []
    for i, d in enumerate(docs):
        r, follow = got[d.doc_id], docs[(i + 1) % len(docs)]
        half = len(d.text) // 2
        edited = d.text[:len(d.text) - half] + follow.text[:half]
        assert r.n_chars == len(d.text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(d.text, r.fingerprint) == r.fingerprint and len(r.fingerprint) == 2 * minhash.BINS
        errors += [r.near_edited - jaccard(d.text, edited), r.near_next - jaccard(d.text, follow.text)]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert max(map(abs, errors)) < 0.15 and abs(sum(errors) / len(errors)) < 0.01


def plain_signature(hashes, rank):
    """Bins, minima, then the rule for empty bins, from the shingle hashes (signed)."""
    bins = {}
    for h in hashes:
        b = (h >> 56) + 128
        bins[b] = min(bins.get(b, h), h)
    out = []
    for i in range(minhash.BINS):
        if i in bins:
            out.append(bins[i])
            continue
        tried = next((bins[c] for t in range(minhash.TRIES) if (c := rank(i, t) & 255) in bins), None)
        if tried is None:
            order = sorted(bins)
            keys = [(rank(i, b) & -256) | p for p, b in enumerate(order)]
            tried = bins[order[min(keys) & 255]]
        out.append(tried)
    return [(h & 255) - 128 for h in out]


def test_signature_follows_its_definition(spark):
    rng = random.Random(0)
    texts = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(n)) for n in (1, 4, 5, 6, 9, 30, 200, 3000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    hashed = df.select("text", F.transform(F.split("text", " "), lambda x: F.xxhash64(x)).alias("w"))
    ranks = {(r.i, r.t): r.h for r in spark.range(256).selectExpr("cast(id as int) i").crossJoin(spark.range(256).selectExpr("cast(id as int) t"))
             .select("i", "t", F.xxhash64("i", "t").alias("h")).collect()}
    spans = hashed.select("text", F.expr("""if(size(w) < 5, array(xxhash64(w)),
        transform(sequence(0, greatest(0, size(w) - 5)), i -> xxhash64(get(w, i), get(w, i+1), get(w, i+2), get(w, i+3), get(w, i+4))))""").alias("s"))
    want = {r.text: plain_signature(r.s, lambda i, t: ranks[i, t]) for r in spans.collect()}
    got = {r.text: list(r.sig) for r in minhash.with_signature(df, "text", "sig").collect()}
    assert got == want


def test_likeness_has_no_bias(spark):
    rng = random.Random(1)
    rows = []
    for share in (0, 100, 200, 300):
        words = [f"a{rng.random()}" for _ in range(400)]
        other = [f"b{rng.random()}" for _ in range(400)]
        rows.append((" ".join(words), " ".join(words[:share] + other[share:])))
    df = spark.createDataFrame(rows, "a string, b string")
    both = minhash.with_signature(minhash.with_signature(df, "a", "x"), "b", "y")
    for r in both.select("a", "b", minhash.likeness("x", "y").alias("near")).collect():
        assert abs(r.near - jaccard(r.a, r.b)) < 0.1


def test_awkward_rows(spark):
    docs = frames.documents(spark)
    rows = minhash.compare_edited(docs).collect()
    assert len(rows) == docs.count()
    none = [r for r in rows if r.fingerprint == "0" * (2 * minhash.BINS)]
    assert len(none) == 3 and {r.id for r in none} == {3, 4, 5}
    sevens = [r.fingerprint for r in rows if r.id == 7]
    assert len(sevens) == 3 and len(set(sevens)) == 2
    third = next(r for r in rows if r.id == 3)
    assert third.near_next == 1.0 and third.n_chars == 0 and third.edited_sha256 == hashlib.sha256(b"").hexdigest()
    assert minhash.compare_edited(docs.where("false")).count() == 0
    one = minhash.compare_edited(docs.where("doc_id = 1")).collect()
    text = "alpha beta gamma delta epsilon zeta eta theta"
    assert one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256((text[:23] + text[:22]).encode()).hexdigest()


def test_successors_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BUCKET_ROWS", 3)
    ids = random.Random(2).sample(range(10 ** 12), 50) + [5, 5, None, None]
    df = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "id long, text string").withColumn("tie", F.xxhash64("text"))
    order = [(r.id, r.text) for r in df.orderBy(F.asc_nulls_first("id"), "tie").collect()]
    got = {(r.id, r.text): r.next_text for r in minhash.with_next(minhash.with_guards(df.repartition(5), df.select("id")), ["text"]).collect()}
    assert got == {row: order[(i + 1) % len(order)][1] for i, row in enumerate(order)}


def test_the_main_path_has_no_python(spark, small):
    plan = queries.QUERIES["op9_minhash"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
