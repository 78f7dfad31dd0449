"""Quality classifier: a linear-chain conditional random field labels every line good or bad.

A line is described by binned measures of its own and of both neighbours. Document labels stand in for line labels when
the chain is fitted: on average they are right, and the neighbour and transition weights carry the rest. The score of a
document is the length-weighted mean of the lines' forward-backward marginals, put on a probability scale by a one-variable
logistic regression.

Defined cases: a null or empty text is one empty line and is scored like any other; rows are scored one by one, so
repeated rows and ids get equal scores; an empty table gives an empty result; only the named id and text columns are read.
Without usable labels every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayworks.llm import crf
from delayworks.llm.common import free_name, held_out, pieces, texts_of

#: Most labelled documents of a class that the chain is fitted on: the classifier's only bound. Scoring reads every row.
FIT_DOCUMENTS = 2000

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGIT = bytes(range(48, 58))
SPACE = b" \t\r\x0b\x0c"
STOPS = b".,;:!?"
OTHER = bytes(i for i in range(33, 127) if i not in UPPER + LOWER + DIGIT + STOPS)

SHARE = np.array([0.001, 0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])
COUNT = np.array([0.5, 1.5, 2.5, 4.5, 8.5, 16.5, 32.5, 64.5, 128.5, 256.5, 512.5])
WIDTH = np.array([1.5, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0, 5.5, 6.0, 7.0, 8.0, 10.0, 14.0, 20.0])
MEASURES = (COUNT, SHARE, SHARE, SHARE, SHARE, SHARE, WIDTH, SHARE, SHARE, SHARE, np.array([0.5, 1.5]))
BINS = [len(m) + 1 for m in MEASURES]
#: Own bins, then those of the line before and after (one more value: there is none).
SIZES = BINS + [n + 1 for n in BINS] * 2


def measures(lines: list[bytes]) -> list[tuple[float, ...]]:
    """Numbers that describe each line: size, kinds of characters, word widths, repetition, whether a neighbour equals it."""
    out = []
    last = len(lines) - 1
    for i, line in enumerate(lines):
        size = len(line) or 1
        words = line.split()
        n = len(words) or 1
        kept = len(line) - len(line.translate(None, SPACE))
        stops = len(line) - len(line.translate(None, STOPS))
        other = len(line) - len(line.translate(None, OTHER))
        upper = len(line) - len(line.translate(None, UPPER))
        digit = len(line) - len(line.translate(None, DIGIT))
        again = sum(map(bytes.__eq__, words[1:], words)) / n
        ends = sum(w[-1] in OTHER or w[-2:] == b"!!" for w in words) / n
        twin = (i > 0 and lines[i - 1] == line) + (i < last and lines[i + 1] == line)
        out.append((len(words), upper / size, digit / size, stops / size, other / size, kept / size,
                    (size - kept) / n, len(set(words)) / n, again, ends, twin))
    return out


@dataclass
class Lines:
    bins: np.ndarray  # lines x measures
    weight: np.ndarray  # characters and the line break
    starts: np.ndarray
    documents: int


def lines_of(texts: list[str]) -> Lines:
    rows, weight, first = [], [], []
    for text in texts:
        lines = text.encode("utf-8", "replace").split(b"\n")
        first.append(len(rows))
        rows.extend(measures(lines))
        weight.extend(len(line) + 1 for line in lines)
    values = np.array(rows, float).reshape(len(rows), len(MEASURES))
    bins = np.stack([np.searchsorted(edges, values[:, k]) for k, edges in enumerate(MEASURES)], axis=1).astype(np.uint8)
    starts = np.zeros(len(rows), bool)
    starts[first] = True
    return Lines(bins, np.array(weight, float), starts, len(texts))


def with_neighbours(lines: Lines) -> list[np.ndarray]:
    bins, starts = lines.bins.astype(np.int64), lines.starts
    none = np.array(BINS)
    before, after = np.empty_like(bins), np.empty_like(bins)
    before[1:], after[:-1] = bins[:-1], bins[1:]
    before[starts] = none
    after[:-1][starts[1:]] = none
    after[-1:] = none
    return [*bins.T, *before.T, *after.T]


@dataclass
class QualityModel:
    chain: crf.Chain
    slope: float
    shift: float

    def scores(self, lines: Lines) -> np.ndarray:
        if not lines.documents:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.slope * document_logit(self.chain, lines) + self.shift, -30, 30)))


def document_logit(chain: crf.Chain, lines: Lines) -> np.ndarray:
    """Log odds of the length-weighted mean of the lines' marginals."""
    good = chain.marginals(with_neighbours(lines), lines.starts)
    begin = np.flatnonzero(lines.starts)
    mean = np.add.reduceat(good * lines.weight, begin) / np.add.reduceat(lines.weight, begin)
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.log(mean / (1 - mean))


def train(texts: list[str], labels: np.ndarray) -> QualityModel:
    """Fit on whole labelled texts; both classes get equal weight in the chain, their true weight in the final scale."""
    labels = np.asarray(labels, int)
    if len(set(labels.tolist())) < 2:
        return QualityModel(crf.fit([np.zeros(0, int)] * len(SIZES), SIZES, np.zeros(0, int), np.zeros(0, bool)), 1.0, 0.0)
    lines = lines_of(texts)
    document = np.cumsum(lines.starts) - 1
    share = lines.weight / np.bincount(document, lines.weight)[document]
    balance = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    chain = crf.fit(with_neighbours(lines), SIZES, labels[document], lines.starts, share * balance[document])
    slope, shift = crf.logistic(document_logit(chain, lines), labels.astype(float), balance)
    return QualityModel(chain, slope, shift)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text",
                  most: int = FIT_DOCUMENTS) -> tuple[list[str], np.ndarray]:
    """Whole texts of at most ``most`` labelled rows of each class, none of them held out, chosen in hash order.

    Labels that are null or contradict each other are left out; texts of a repeated id all count.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
             .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("id"))
             .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top").drop("top"))
    order = [F.xxhash64("id"), F.col("id")]
    chosen = known.where("y = 0").orderBy(*order).limit(most).unionAll(known.where("y = 1").orderBy(*order).limit(most))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), "id").select("id", "text", "y").toPandas())
    rows = rows.sort_values(["id", "text"], na_position="first")
    return [t if isinstance(t, str) else "" for t in rows["text"]], rows["y"].to_numpy(int)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
        most: int = FIT_DOCUMENTS) -> QualityModel:
    return train(*training_rows(docs, labels, label, id_col, text_col, most))


def score(model: QualityModel, text: Column | str) -> Column:
    """Score of whole texts between 0 and 1, as a column expression."""

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        parts = [model.scores(lines_of(texts_of(piece))) for piece in pieces(column)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return scored.asNondeterministic()(F.col(text) if isinstance(text, str) else text)


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose score reaches the threshold, with their columns."""
    name = free_name(docs, "quality_score")
    return docs.withColumn(name, score(model, text_col)).where(F.col(name) >= threshold).drop(name)


def line_marginals(model: QualityModel, text: str) -> pd.DataFrame:
    """The lines of one text with their probability of being good."""
    lines = lines_of([text])
    return pd.DataFrame({"line": text.split("\n"), "good": model.chain.marginals(with_neighbours(lines), lines.starts)})
