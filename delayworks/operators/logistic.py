"""L2-regularised logistic regression for many strengths and folds at once.

Every Newton step is one pass over the rows: a task adds up gradient, curvature and loss of all (fold, strength) pairs for
the rows of its partitions, and the sums meet per pair. The driver holds one matrix of the number of features squared
for each pair, so the number of features is bounded by ``MOST_FEATURES``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most features of a search by Newton steps; wider tables are searched one strength at a time.
MOST_FEATURES = 256
PASSES, ENOUGH = 60, 1e-9
#: Products of two features that a task holds at once, and the most rows of a step.
PRODUCTS, BATCH_ROWS = 1_000_000, 4096
#: Held-out margins that one task gives: the counts per score that follow hold nearly one entry for each.
SCORES_A_TASK = 1_000_000


def _sums(x, y, w, fold, pairs, coefficients):
    """Per pair: weight, loss, gradient and curvature of rows outside its fold, in one vector.

    All pairs of a fold share the products of two features of a row: their curvatures are one matrix product.
    """
    width = x.shape[1]
    out = np.empty((len(pairs), 2 + width * (1 + width)))
    i, j = np.triu_indices(width)
    for held in {held for held, _ in pairs}:
        own = [k for k, (f, _) in enumerate(pairs) if f == held]
        rest = fold != held
        xs, ys, ws = x[rest], y[rest][:, None], w[rest][:, None]
        margin = xs @ coefficients[own].T
        small = np.exp(-np.abs(margin))
        p = np.where(margin >= 0, 1.0, small) / (1 + small)
        loss = (ws * (np.maximum(margin, 0) + np.log1p(small) - ys * margin)).sum(axis=0)
        half = ((ws * p * (1 - p)).T @ (xs[:, i] * xs[:, j]))
        curve = np.empty((len(own), width, width))
        curve[:, i, j] = curve[:, j, i] = half
        out[own] = np.c_[np.full(len(own), ws.sum()), loss, (ws * (p - ys)).T @ xs, curve.reshape(len(own), -1)]
    return out


def fit_path(rows: DataFrame, label: str, pairs: list[tuple[int, float]], weight: str = "weight") -> tuple[np.ndarray, int]:
    """Coefficients (intercept last) for each (held-out fold, penalty), and the number of passes.

    ``rows`` has ``features``, ``fold``, the label and the weight, and is read once a pass: pass a stored table. A pair's
    mean loss over the rows outside its fold plus half its penalty times the squared coefficients is least.
    """
    columns = rows.where(F.col(label).isNotNull() & F.col(weight).isNotNull()).select(
        vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"), F.col("fold").cast("int").alias("fold"))
    first = columns.select("x").first()
    width = 1 + (len(first.x) if first else 0)
    penalty = np.array([s for _, s in pairs])[:, None] * np.r_[np.ones(width - 1), 0.0]
    beta = np.zeros((len(pairs), width))
    accepted, best, step = beta.copy(), np.full(len(pairs), np.inf), np.zeros_like(beta)
    for number in range(1, PASSES + 1):
        total = _pass(columns, pairs, beta, width)
        mass = np.maximum(total[:, :1], 1e-300)
        value = total[:, 1] / mass[:, 0] + 0.5 * (penalty * beta ** 2).sum(axis=1)
        worse = value > best + 1e-12
        step[worse] /= 2  # a step that went too far is halved
        better = ~worse
        accepted[better], best[better] = beta[better], value[better]
        gradient = total[:, 2:2 + width] / mass + penalty * beta
        for k in np.flatnonzero(better):
            curve = total[k, 2 + width:].reshape(width, width) / mass[k] + np.diag(penalty[k]) + 1e-12 * np.eye(width)
            step[k] = -solved(curve, gradient[k])
        beta = accepted + step
        if np.abs(step).max(initial=0.0) < ENOUGH:
            break
    return accepted, number


def solved(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Gaussian elimination. The driver's threaded linear algebra library can wait forever once its process has forked."""
    both = np.c_[matrix, right]
    for i in range(len(both)):
        pivot = i + int(np.argmax(np.abs(both[i:, i])))
        both[[i, pivot]] = both[[pivot, i]]
        both[i] /= both[i, i] or 1e-300
        factor = both[:, i].copy()
        factor[i] = 0.0
        both -= factor[:, None] * both[i]
    return both[:, -1]


def _pass(columns: DataFrame, pairs, beta: np.ndarray, width: int) -> np.ndarray:
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(pairs), 2 + width * (1 + width)))
        step = max(1, min(BATCH_ROWS, 2 * PRODUCTS // (width * (width + 1))))
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                y, w, fold = (part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "fold"))
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), width - 1)
                total += _sums(np.c_[x, np.ones(len(y))], y, w, fold, pairs, beta)
        yield packed(dict(enumerate(total)))

    out = np.zeros((len(pairs), 2 + width * (1 + width)))
    for k, sums in added_up(columns.mapInArrow(partial, "number int, sums binary")).items():
        out[k] = sums
    return out


def packed(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    """A row per number with its array."""
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["number", "sums"])


def added_up(parts: DataFrame) -> dict[int, np.ndarray]:
    """Partial sums of tasks added up per number: one array each on the driver."""
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("number").to_pylist(), batch.column("sums").to_pylist()):
                held[k] = held.get(k, 0.0) + np.frombuffer(raw)
        if held:
            yield packed(held)

    summed = parts.repartition("number").mapInArrow(added, "number int, sums binary")
    return {r.number: np.frombuffer(r.sums) for r in summed.collect()}  # one row per number


def held_out_scores(rows: DataFrame, label: str, pairs: list[tuple[int, float]], beta: np.ndarray) -> DataFrame:
    """``(class, score, hit)``: each row's margin under every pair that held its fold out; the class is the pair's number.

    A row gives many margins, so rows are dealt out by number: a stored table of few bytes would be few tasks whose counts
    grow with the table.
    """
    columns = rows.where(F.col(label).isNotNull()).select(vector_to_array("features").alias("x"), F.col(label).cast("int").alias("hit"), F.col("fold").cast("int").alias("fold"))
    by_fold = {f: [k for k, (held, _) in enumerate(pairs) if held == f] for f in {held for held, _ in pairs}}
    tasks = math.ceil(rows.count() * max(map(len, by_fold.values()), default=0) / SCORES_A_TASK)
    columns = columns.repartition(tasks) if tasks > 1 else columns

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, hit = batch.column("fold").to_numpy(zero_copy_only=False), batch.column("hit").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(hit), -1)
            for f, own in by_fold.items():
                at = np.flatnonzero(fold == f)
                margins = np.c_[x[at], np.ones(len(at))] @ beta[own].T
                for j, k in enumerate(own):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(margins[:, j]), pa.array(hit[at].astype(np.int32))],
                                                     ["class", "score", "hit"])

    return columns.mapInArrow(scored, "class int, score double, hit int")
