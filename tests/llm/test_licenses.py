"""Licence scans: the automaton against plain search, phrases, chains."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from delayworks.llm import licenses, queries
from tests.llm import frames

SCANNER = licenses.Scanner()


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(text):
    w = words(text)
    places = [(i, label) for phrase, label in licenses.PHRASES for p in [phrase.split()]
              for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return (len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
            ",".join(sorted({label for _, label in places})))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=7), min_size=1, max_size=3), st.lists(st.integers(0, 3), max_size=25))
def test_matching_statistics(templates, text):
    automaton = licenses.SuffixAutomaton(templates)
    runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for at, (state, length) in enumerate(automaton.statistics(text)):
        want = max((n for n in range(at + 2) if n == 0 or tuple(text[at + 1 - n:at + 1]) in runs), default=0)
        assert length == want
        if length:
            run = text[at + 1 - length:at + 1]
            ends = {(k, j) for k, t in enumerate(templates) for j in range(len(t)) if j + 1 >= length and t[j + 1 - length:j + 1] == run}
            assert automaton.ends[state] == ends


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10 ** 9))
def test_phrases_are_found_wherever_they_stand(seed):
    rng = random.Random(seed)
    vocabulary = [w for t, _ in (*licenses.PHRASES, *licenses.TEMPLATES) for w in t.split()]
    parts = [rng.choice([rng.choice(vocabulary), rng.choice(licenses.PHRASES)[0], "x", "É", "-"]) for _ in range(rng.randint(0, 30))]
    text = rng.choice([" ", "\n", "-"]).join(parts).replace("mit", rng.choice(["mit", "MIT"]))
    found = SCANNER.scan(licenses.words_of(text))
    assert tuple(found[k] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == plain(text)
    assert set(filter(None, found["base_labels"].split(","))) <= set(filter(None, found["labels"].split(",")))
    assert 0 <= found["score"] <= 1


def test_a_changed_notice_is_chained():
    notice = dict((label, t) for t, label in reversed(licenses.TEMPLATES))["mit"]
    w = notice.split()
    w[10:11], w[30:32] = ["changed", "words"], []
    text = "before it all " + " ".join(w) + " and after"
    found = SCANNER.scan(licenses.words_of(text))
    span = next(s for s in found["spans"] if s["label"] == "mit")
    assert found["labels"] == "mit" and found["base_labels"] == "" and span["coverage"] > 0.85
    assert span["start"] == 3 and span["end"] == 3 + len(w)
    assert SCANNER.scan(licenses.words_of(" ".join(notice.split()[:12])))["labels"] == ""


def test_the_whole_table(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = queries.QUERIES["op10_licenses"](spark, small).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id])


def test_awkward_rows(spark):
    docs = frames.documents(spark)
    rows = docs.select("text", licenses.scan("text").alias("s")).collect()
    assert len(rows) == docs.count() and all(r.s.n_words == len(words(r.text)) for r in rows)
    assert {(r.s.n_base, r.s.labels, r.s.score) for r in rows if not (r.text or "").strip()} == {(0, "", 0.0)}
    assert docs.where("false").select(licenses.scan("text").alias("s")).count() == 0
