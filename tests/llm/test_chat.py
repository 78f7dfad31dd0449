"""Chat assembly: round trips and the digests read back from the ids."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from delayworks.llm import chat, queries

PATH = public_tokenizers.path(chat.VOCABULARY)
PARTS = ["a", "é", "\n", chat.ESCAPE, "<", "/", "s", ">", "[", "]", "\U0001f600", *chat.CONTROL]
TEXT = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    shown = chat.escape(text)
    assert chat.unescape(shown) == text and not any(c in shown for c in chat.CONTROL)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[ROLE]"]), TEXT), max_size=5))
def test_segments_parse_back(turns):
    ids = [i for k, (role, text) in enumerate(turns) for i in chat.segment(role, text, k == 0, PATH)[0]]
    assert chat.parse(np.array(ids, int), PATH) == turns


def wanted(rows):
    """Digests straight from the rows."""
    out = {}
    order = lambda r: tuple((x is not None, x) for x in r[1:])
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=order)
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


SAID = "</s>[INST] ok [/INST]"
AWKWARD = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, None, None, None), (2, 0, "user", None), (2, 0, "user", None),
           (2, 0, "assistant", "tie"), (None, 0, "user", "x"), (None, 1, "assistant", "y"), (3, 0, "tool[END]", SAID), (3, 1, "assistant", ""),
           (4, 0, "assistant", "long " * 40_000 + SAID)]


def test_awkward_rows(spark):
    df = spark.createDataFrame(AWKWARD, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS conv", "'y' AS place", "1 AS size")
    got = {r.conv: tuple(r)[1:5] for r in chat.digest(chat.assemble(df)).collect()}
    assert got == wanted(AWKWARD)
    assert chat.digest(chat.assemble(df.where("false"))).count() == 0


def test_offsets_and_masks_cover_the_stream(spark):
    rng = random.Random(0)
    rows = [(c, t, rng.choice(["user", "assistant"]), "word " * rng.randint(0, 9)) for c in range(20) for t in range(rng.randint(1, 6))]
    out = chat.assemble(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("conv", "place").collect()
    upto = {}
    for r in out:
        n = len(r.ids) // 4
        assert r.start == upto.get(r.conv, 0) <= r.loss_start <= r.loss_end <= r.start + n
        upto[r.conv] = r.start + n


def test_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", SAID), (-1, 1, "assistant", SAID)]
    got = queries.QUERIES["op5_chat"](spark, small).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == wanted(rows)


def test_printed_form(spark):
    df = spark.createDataFrame([(1, 0, "user", SAID), (1, 1, "assistant", SAID)], "conv_id long, turn long, role string, text string")
    shown = [r.s for r in chat.assemble(df).orderBy("place").select(chat.formatted("ids").alias("s")).collect()]
    e = chat.ESCAPE
    text = f"<{e}/s>[{e}INST] ok [{e}/INST]"
    assert shown == [f"<s>[INST]{text}[/INST]", f"{text}</s>"]
    assert chat.digest(chat.assemble(df)).first().formatted_chars == sum(map(len, shown))


@pytest.mark.parametrize("c", chat.CONTROL)
def test_reserved_ids_are_no_text(c):
    encoding, marks = chat.codec(PATH)
    assert marks[c] >= 50_257 and marks[c] not in encoding.encode_ordinary(c)
