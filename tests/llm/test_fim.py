"""Fill-in-the-middle: forms and cuts, round trips over any piece boundaries, digests against a plain version."""

from collections import Counter
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from delayworks.llm import fim
from tests.llm import frames


def plain(doc_id, text):
    text = text or ""
    n = len(text)
    h = sha256(b"1:" + ("" if doc_id is None else str(doc_id)).encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def sha(text):
    return sha256(text.encode()).hexdigest()


def texts(spark):
    awkward = ["<", "<P", "P>", "<<P", "a<P>b", "<S>", "<M>", "😀" * 5000 + "x", "é" * 4096, "ab" * 4096 + "<", "<M" * 3000, "\n\t "]
    rows = [(i, awkward[i % len(awkward)] + "z" * (i // len(awkward)), None, None, None) for i in range(150)]
    return frames.documents(spark).select("doc_id", "text", "lang", "source", "n_chars").unionAll(frames.documents(spark, rows).select(
        "doc_id", "text", "lang", "source", "n_chars"))


@pytest.mark.parametrize("chunk", [1, 7, fim.CHUNK])
def test_digests_equal_the_plain_version(spark, chunk):
    df = texts(spark) if chunk > 1 else texts(spark).where(F.length("text") < 300)
    expected = [plain(r["doc_id"], r["text"]) for r in df.collect()]
    got = fim.digests(df, chunk=chunk).collect()
    assert Counter(map(tuple, got)) == Counter((*e[:5], sha(e[5]), sha(t or "")) for e, t in zip(expected, (r["text"] for r in df.collect())))
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_outputs_restore_to_their_texts(spark):
    df = texts(spark)
    made = fim.outputs(fim.pieces_of(df)).collect()
    assert Counter(map(tuple, made)) == Counter(plain(r["doc_id"], r["text"]) for r in df.collect())
    assert Counter((r["id"], fim.restore(r["output"], r["form"])) for r in made) == Counter((r["doc_id"], r["text"] or "") for r in df.collect())


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("<>PSMa"), max_size=20), st.data())
def test_parser_takes_any_cut_of_the_stream(text, data):
    if any(s in text for s in fim.SENTINELS.values()):
        return
    a = data.draw(st.integers(0, len(text)))
    b = data.draw(st.integers(a, len(text)))
    for form in ("psm", "spm"):
        whole = "".join(fim.output_chunks(text, form, a, b - a, data.draw(st.integers(1, 5))))
        cuts = sorted(data.draw(st.lists(st.integers(0, len(whole)), max_size=4)))
        parser, found = fim.Parser(form), []
        for lo, hi in zip([0, *cuts], [*cuts, len(whole)]):
            found += parser.feed(whole[lo:hi])
        found += parser.close()
        assert "".join(t for _, _, t in sorted(found)) == text


def test_empty_table_and_null_text(spark):
    empty = frames.documents(spark).limit(0)
    assert fim.digests(empty).collect() == [] and fim.outputs(fim.pieces_of(empty)).collect() == []
    one = spark.createDataFrame([(None, None)], "doc_id string, text string")
    assert fim.digests(one).first()[:3] == (None, 0, "plain")


def test_one_shuffle(spark, small):
    plan = fim.digests(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
