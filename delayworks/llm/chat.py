"""Chat formatting by token-level assembly.

Every turn's text is encoded on its own with a byte-level vocabulary; control marks are reserved ids above that
vocabulary, spliced in between, so no text can produce one. In addition control strings inside a text are escaped, so
the printed form is unambiguous too. Token offsets of turns and of their loss spans are prefix sums of segment lengths.

A turn's segment: ``<s>`` at the start of a conversation, a mark for its role (an unlisted role is written out between
two marks), the text, and the mark that ends the turn. The loss covers the text tokens of assistant turns.

Turns are ordered by (turn, role, text), nulls first: ties and repeated rows have a defined place. A null text is empty, a
null role is the empty role; a null conversation id is a conversation of its own. Only the four named columns are read.
Encoding is a map over rows; a long conversation is then one sorted stream of its segments, never a collected group.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The printed control strings and, by position, their reserved ids after the vocabulary.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[END]")
ESCAPE = "␛"
TURN = {"user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>"), "assistant": (None, "</s>")}
LOSS_ROLE = "assistant"
VOCABULARY = "byte_bpe_50k.tiktoken"

_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
_ESCAPED = re.compile(ESCAPE + "(" + ESCAPE + "?)")
_CODECS: dict[str, tuple[tiktoken.Encoding, dict[str, int]]] = {}


def codec(path: str) -> tuple[tiktoken.Encoding, dict[str, int]]:
    """The vocabulary at ``path`` and the reserved ids, loaded once per process."""
    if path not in _CODECS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        first = max(ranks.values()) + 2
        encoding = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _CODECS[path] = encoding, {c: first + i for i, c in enumerate(CONTROL)}
    return _CODECS[path]


def escape(text: str) -> str:
    """Doubles the escape character and splits each control string after its first character."""
    return _CONTROL.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text.replace(ESCAPE, ESCAPE * 2))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def segment(role: str, text: str, opens: bool, path: str) -> tuple[list[int], int, int]:
    """Ids of one turn, and where its text begins and ends among them."""
    encoding, marks = codec(path)
    head = [marks["<s>"]] if opens else []
    start, end = TURN.get(role, ("[ROLE]", "[END]"))
    if start:
        head.append(marks[start])
    if role not in TURN:
        head += [*encoding.encode_ordinary(escape(role)), marks["[/ROLE]"]]
    body = encoding.encode_ordinary(escape(text))
    return [*head, *body, marks[end]], len(head), len(head) + len(body)


def encoder(path: str):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, begin, end, size = [], [], [], []
            for role, text, opens in zip(*(batch.column(c).to_pylist() for c in ("role", "text", "opens"))):
                row, b, e = segment(role or "", text or "", opens, path)
                ids.append(np.array(row, "<u4").tobytes())
                begin.append(b)
                end.append(e)
                size.append(len(row))
            kept = [batch.column(c) for c in ("conv", "place", "is_loss")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(ids, pa.binary()), pa.array(begin, pa.int64()), pa.array(end, pa.int64()), pa.array(size, pa.int64())],
                ["conv", "place", "is_loss", "ids", "begin", "end", "size"])

    return encoded


def assemble(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
             path: str | None = None) -> DataFrame:
    """One row per turn: ``conv, place, ids`` (little-endian 32-bit), ``start`` (its offset in the conversation's token
    stream) and ``loss_start, loss_end`` (offsets of the tokens under the loss; equal where there are none)."""
    path = path or public_tokenizers.path(VOCABULARY)
    order = Window.partitionBy("conv").orderBy(*(F.asc_nulls_first(c) for c in ("turn", "role", "text")))
    turns = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                        F.col(text_col).alias("text"))
    placed = turns.withColumn("place", F.row_number().over(order).cast("long") - 1)
    ready = placed.select("conv", "place", "role", "text", (F.col("place") == 0).alias("opens"),
                          F.coalesce(F.col("role") == LOSS_ROLE, F.lit(False)).alias("is_loss"))
    conv = ready.schema["conv"].dataType.simpleString()
    encoded = ready.mapInArrow(
        encoder(path), f"conv {conv}, place long, is_loss boolean, ids binary, begin long, end long, size long")
    so_far = Window.partitionBy("conv").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(so_far), F.lit(0).cast("long"))
    return encoded.withColumn("start", start).select(
        "conv", "place", "ids", "start", (F.col("start") + F.col("begin")).alias("loss_start"),
        (F.col("start") + F.when(F.col("is_loss"), F.col("end")).otherwise(F.col("begin"))).alias("loss_end"))


def parse(ids: np.ndarray, path: str) -> list[tuple[str, str]]:
    """(role, text) of every turn in a run of ids: the inverse of :func:`segment`."""
    encoding, marks = codec(path)
    names = {i: c for c, i in marks.items()}
    opening = {start: (role, end) for role, (start, end) in TURN.items() if start}
    closing = {end: role for role, (start, end) in TURN.items() if not start}
    turns, held, role = [], [], None
    for i in ids.tolist():
        mark = names.get(i)
        if mark is None:
            held.append(i)
        elif mark in opening:
            role, held = opening[mark][0], []
        elif mark in ("<s>", "[ROLE]"):
            held = []
        elif mark == "[/ROLE]":
            role, held = text_of(held, encoding), []
        else:
            turns.append((role if role is not None else closing[mark], text_of(held, encoding)))
            role, held = None, []
    return turns


def text_of(ids: list[int], encoding: tiktoken.Encoding) -> str:
    return unescape(encoding.decode_bytes(ids).decode("utf-8"))


def printed(ids: np.ndarray, path: str) -> str:
    """The formatted string: texts escaped, marks as their control strings."""
    encoding, marks = codec(path)
    names = {i: c for c, i in marks.items()}
    out, held = [], []
    for i in ids.tolist():
        if i in names:
            out += [encoding.decode_bytes(held).decode("utf-8"), names[i]]
            held = []
        else:
            held.append(i)
    return "".join([*out, encoding.decode_bytes(held).decode("utf-8")])


def digest(assembled: DataFrame, path: str | None = None) -> DataFrame:
    """Per conversation, read back from the ids: turns, their digest, the text under the loss and its digest, printed size.

    The rows of a conversation arrive as one sorted stream; a running digest is all that is held.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    conv = assembled.schema["conv"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _ = codec(path)
        schema = None
        current, state, done = None, None, []

        def finished():
            done.append((current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            schema = batch.schema.field("conv").type
            columns = [batch.column(c).to_pylist() for c in ("conv", "ids", "start", "loss_start", "loss_end")]
            for key, raw, start, lo, hi in zip(*columns):
                if state is None or key != current:
                    if state is not None:
                        finished()
                    current, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = np.frombuffer(raw, "<u4")
                for role, text in parse(ids, path):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                loss = text_of(ids[lo - start:hi - start].tolist(), encoding)
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(printed(ids, path))
            if len(done) >= 1024:
                yield rows(done, schema)
                done.clear()
        if state is not None:
            finished()
            yield rows(done, schema)

    def rows(done, kind):
        columns = list(zip(*done))
        kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return (assembled.repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(
        read, f"conv {conv}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


def formatted(ids: Column | str, path: str | None = None) -> Column:
    """The printed form of a row's ids."""
    path = path or public_tokenizers.path(VOCABULARY)

    @F.arrow_udf("string")
    def shown(column: pa.Array) -> pa.Array:
        return pa.array([printed(np.frombuffer(raw, "<u4"), path) for raw in column.to_pylist()], pa.string())

    return shown(F.col(ids) if isinstance(ids, str) else ids)
