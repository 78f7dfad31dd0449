"""Boosting rounds on tables of any size: the trees of all classes grow together from histograms.

Rows are coded once: a number by at most ``BINS`` weighted quantiles over all rows, a categorical column by the number of
its value, whose one-hot features are then counted together. Coded rows are put together to blocks, so that a pass hands few
large values to Python instead of every row. A level of a round is then one pass for all classes: a task
adds up curvature, gradient and squares per class, open node, column and code for the rows of its partitions, and the sums
meet per class. The driver holds one histogram a class, whose size does not depend on the rows. Splits are chosen as the
library's regression trees choose them (least variance), and the trees that come out are its own.

Held-out rows are coded with the thresholds of the others and counted for the loss only. A tree that learns from a share of
the rows draws them by their numbers, the same ones in every pass; a node draws the features that it may ask.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.operators.logistic import added_up, packed
from delayworks.sources.staging import stage

#: Most bins of a feature.
BINS = 32
#: Points that a partition keeps of a feature's distribution when it has more values.
POINTS = 1024
#: The same for medians.
MEDIAN_POINTS = 4096
BATCH_ROWS = 65_536
#: Most rows of a block, and bytes that more than one row may have in it: a batch holds ten thousand blocks.
BLOCK_ROWS, BLOCK_BYTES = 32, 2048
#: Blocks are read about as many rows at a time.
PART_ROWS = 32_768
#: Rounds between stored margins.
STORED_EVERY = 8
#: Cells that columns counted together may have over all open nodes: their counters stay in a core's cache.
CELLS = 16_384
#: Nodes of a tree up to which all of them are asked for every row, without choosing rows.
ASKED_NODES = 128
BLOCK = "number long, held boolean, codes binary, y binary, w binary, margins binary"


@dataclass(frozen=True)
class Coded:
    """A column of codes: the bins of feature ``first``, or the values of a category, each but the last a feature from ``first`` on."""

    first: int
    size: int
    limits: np.ndarray | None = None


@dataclass
class Tree:
    """Nodes by number, the root first; a node without a column is a leaf. ``stats``: weight, sum and sum of squares.

    A row goes right if its code is above the cut, or, where the column is a category, if it is the cut.
    """

    column: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    only: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    stats: list[np.ndarray] = field(default_factory=lambda: [np.zeros(3)])

    def split(self, node: int, column: int, cut: int, only: bool, gain: float, left: np.ndarray, right: np.ndarray) -> list[int]:
        ends = [len(self.column), len(self.column) + 1]
        self.column[node], self.cut[node], self.only[node], self.gain[node], (self.left[node], self.right[node]) = column, cut, only, gain, ends
        for stats in (left, right):
            for held, value in ((self.column, -1), (self.cut, 0), (self.only, False), (self.left, 0), (self.right, 0), (self.gain, 0.0), (self.stats, stats)):
                held.append(value)
        return ends

    def onward(self, node: int, asked: np.ndarray) -> np.ndarray:
        return asked == self.cut[node] if self.only[node] else asked > self.cut[node]

    def reached(self, codes: np.ndarray) -> np.ndarray:
        """The node that each row ends in; ``codes`` has a row per column."""
        if len(self.column) <= ASKED_NODES:
            return np.zeros(codes.shape[1], np.uint8) + self._below(0, codes)
        at = np.zeros(codes.shape[1], np.int64)
        todo = [(0, np.arange(codes.shape[1]))]
        while todo:
            node, rows = todo.pop()
            if self.column[node] < 0:
                at[rows] = node
                continue
            onward = self.onward(node, codes[self.column[node]][rows])
            todo += [(self.left[node], rows[~onward]), (self.right[node], rows[onward])]
        return at

    def _below(self, node: int, codes: np.ndarray) -> np.ndarray | np.uint8:
        """The ends of all rows as if they had come to a node."""
        if self.column[node] < 0:
            return np.uint8(node)
        left, right = self._below(self.left[node], codes), self._below(self.right[node], codes)
        return left ^ ((left ^ right) & -self.onward(node, codes[self.column[node]]).view(np.uint8))

    def values(self, codes: np.ndarray) -> np.ndarray:
        return np.array([s[1] / s[0] if s[0] else 0.0 for s in self.stats])[self.reached(codes)]


def impurity(stats: np.ndarray) -> np.ndarray:
    """Variance out of weight, sum and sum of squares (last axis)."""
    weight = np.where(stats[..., 0] > 0, stats[..., 0], 1.0)
    return np.where(stats[..., 0] > 0, (stats[..., 2] - stats[..., 1] ** 2 / weight) / weight, 0.0)


def merged(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.Table]:
    """Batches put together to about ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def matrix(table: pa.Table, name: str) -> np.ndarray:
    """A column of arrays of one length."""
    return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def thinned(values: np.ndarray, weights: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values with their weights; of more than ``most`` the ones at even steps of weight, which take in those before them."""
    found, place = np.unique(values, return_inverse=True)
    mass = np.bincount(place, weights=weights, minlength=len(found))
    if len(found) <= most:
        return found, mass
    upto = np.cumsum(mass)
    kept = np.unique(np.r_[np.searchsorted(upto, upto[-1] * np.arange(1, most) / most).clip(max=len(found) - 1), len(found) - 1])
    return found[kept], np.diff(np.r_[0.0, upto[kept]])


def cuts(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between neighbouring values: all of them if there are few, else those nearest to even shares of the weight."""
    values, weights = thinned(values, weights, 1 << 62)
    middle = (values[1:] + values[:-1]) / 2
    if len(values) <= bins:
        return middle
    upto, wanted = np.cumsum(weights)[:-1], weights.sum() * np.arange(1, bins) / bins
    after = np.searchsorted(upto, wanted).clip(1, len(upto) - 1)
    nearest = np.where(wanted - upto[after - 1] <= upto[after] - wanted, after - 1, after)
    return middle[np.unique(nearest)]


def thresholds(rows: DataFrame, bins: int = BINS) -> dict[int, np.ndarray]:
    """Thresholds of each feature that has any, from all rows of ``(x, w)``."""
    return {i: found for i, found in distributions(rows, lambda values, weights: cuts(values, weights, bins)).items() if len(found)}


def medians(rows: DataFrame, names: list[str]) -> list[float | None]:
    """The middle value of each column, the lower one of two, nulls and NaN left out; its rank is off by less than ``1 / MEDIAN_POINTS``
    of the rows, and exact if a partition has no more values than that."""
    def middle(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
        values, weights = thinned(values, weights, 1 << 62)
        upto = np.cumsum(weights)
        return values[np.searchsorted(upto, np.ceil(upto[-1:] / 2))]

    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(math.nan)) for c in names])
    found = distributions(rows.select(x.alias("x"), F.lit(1.0).alias("w")), middle, MEDIAN_POINTS)
    return [float(found[i][0]) if len(found.get(i, ())) else None for i in range(len(names))]


def distributions(rows: DataFrame, asked: Callable[[np.ndarray, np.ndarray], np.ndarray], most: int = POINTS) -> dict[int, np.ndarray]:
    """What ``asked`` makes of each feature's values and their weights, from all rows of ``(x, w)``; NaN is left out.

    A partition keeps at most ``most`` points of a feature.
    """
    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for table in merged(batches):
            x, w = matrix(table, "x"), numbers(table, "w")
            for i in range(x.shape[1]):
                v, m = held.get(i, (x[:0, i], w[:0]))
                known = ~np.isnan(x[:, i])
                held[i] = thinned(np.r_[v, x[known, i]], np.r_[m, w[known]], most)
        if held:
            yield packed({i: np.r_[v, m] for i, (v, m) in held.items()})

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for i, raw in zip(batch.column("number").to_pylist(), batch.column("sums").to_pylist()):
                parts.setdefault(i, []).append(np.frombuffer(raw).reshape(2, -1))
        if parts:
            yield packed({i: asked(*np.concatenate(p, axis=1)) for i, p in parts.items()})

    kind = "number int, sums binary"
    found = rows.mapInArrow(points, kind).repartition("number").mapInArrow(joined, kind).collect()  # one row per feature
    return {r.number: np.frombuffer(r.sums) for r in sorted(found, key=lambda r: r.number)}


def binned(rows: DataFrame, columns: list[Coded]) -> DataFrame:
    """``(codes, y, w, held)``: the number of thresholds below a value, then the numbers of the categories."""
    bounds, kind = [(c.first, c.limits) for c in columns if c.limits is not None], _kind(columns)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            x, c = matrix(table, "x"), matrix(table, "c")
            codes = np.empty((len(x), max(1, len(columns))), kind)
            codes[:, :1] = 0
            for j, (i, limits) in enumerate(bounds):
                codes[:, j] = np.searchsorted(limits, x[:, i], side="left")
            codes[:, len(bounds):len(columns)] = c
            ends = np.arange(len(x) + 1, dtype=np.int32) * (codes.shape[1] * codes.itemsize)
            packed_codes = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(codes)])
            yield pa.RecordBatch.from_arrays([packed_codes, *[batch.column(name) for name in ("y", "w", "held")]], ["codes", "y", "w", "held"])

    return rows.mapInArrow(coded, "codes binary, y int, w double, held boolean")


@dataclass(frozen=True)
class Part:
    """Coded rows of some blocks: ``codes`` has a row per column, ``margins`` one per class.

    ``y`` is the place of a class, -1 for none of them. The rows that fill up a block have no weight.
    """

    number: np.ndarray
    held: np.ndarray
    codes: np.ndarray
    y: np.ndarray
    w: np.ndarray
    margins: np.ndarray

    def records(self) -> pa.RecordBatch:
        """A record per block."""
        n = len(self.number)
        cut = lambda x: np.ascontiguousarray(x.reshape(*x.shape[:-1], n, -1).swapaxes(0, -2)) if x.ndim > 1 else np.ascontiguousarray(x)
        raw = [_binary(cut(x), n) for x in (self.codes, self.y, self.w, self.margins)]
        return pa.RecordBatch.from_arrays([pa.array(self.number), pa.array(self.held), *raw], ["number", "held", "codes", "y", "w", "margins"])

    def moved(self, pending: list[list[Tree]], step: float) -> np.ndarray:
        """Stored margins and the trees since then."""
        margins = self.margins.copy()
        for trees in pending:
            for k, tree in enumerate(trees):
                margins[k] += step * tree.values(self.codes)
        return margins

    def drawn(self, rate: float, seed: int) -> np.ndarray:
        """Rows that a tree learns from, the same whenever they are asked for."""
        rows = len(self.w) // len(self.number)
        place = (self.number[:, None] * rows + np.arange(rows)).ravel().view(np.uint64)
        return mixed(place + mixed(np.array([seed], np.uint64))) < np.uint64(rate * 2.0 ** 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers as even as drawn ones, out of any (the finaliser of splitmix64)."""
    x = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _binary(values: np.ndarray, n: int) -> pa.Array:
    """``n`` binary values of one length."""
    ends = np.arange(n + 1, dtype=np.int32) * (values.nbytes // max(1, n))
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(values)])


def _bytes(column: pa.Array) -> np.ndarray:
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]]


def block_rows(columns: list[Coded], classes: int) -> int:
    return max(1, min(BLOCK_ROWS, BLOCK_BYTES // (len(columns) * _kind(columns).itemsize + 10 + 8 * classes)))


def blocks(rows: DataFrame, columns: list[Coded], classes: tuple[int, ...], start: list[float]) -> DataFrame:
    """Coded rows put together to blocks of learned or held-out ones, with their first margins."""
    kind, size = _kind(columns), block_rows(columns, len(classes))

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for table in merged(batches):
            codes, labels, w, held = _codes(table, kind), numbers(table, "y"), numbers(table, "w"), numbers(table, "held")
            y = np.full(len(w), -1, np.int16)
            for i, k in enumerate(classes):
                y[labels == k] = i
            for out in (False, True):
                own = np.flatnonzero(held == out)
                if not len(own):
                    continue
                n = -(-len(own) // size)
                more = n * size - len(own)
                filled = [np.pad(x[..., own], ((0, 0),) * (x.ndim - 1) + ((0, more),), constant_values=empty) for x, empty in ((codes, 0), (y, -1), (w, 0.0))]
                margins = np.repeat(np.array(start, float)[:, None], n * size, axis=1)
                yield Part(np.arange(number, number + n), np.full(n, out), *filled, margins).records()
                number += n

    return rows.mapInArrow(together, BLOCK)


def read_parts(batches: Iterator[pa.RecordBatch], columns: list[Coded], classes: int) -> Iterator[Part]:
    kind, size = _kind(columns), block_rows(columns, classes)
    step = max(1, PART_ROWS // size)
    for whole in batches:
        for lo in range(0, whole.num_rows, step):
            batch = whole.slice(lo, step)
            n = batch.num_rows
            codes, y, w, margins = (_bytes(batch.column(name)).view(t) for name, t in (("codes", kind), ("y", np.int16), ("w", float), ("margins", float)))
            put = lambda x: np.ascontiguousarray(x.reshape(n, -1, size).swapaxes(0, 1)).reshape(-1, n * size)
            yield Part(batch.column("number").to_numpy(), batch.column("held").to_numpy(zero_copy_only=False), put(codes), y, w, put(margins))


@dataclass
class Prepared:
    """Blocks of coded rows, their columns and the number of features; fits of the same rows can share them."""

    columns: list[Coded]
    width: int
    state: DataFrame


def prepare(rows: DataFrame, classes: tuple[int, ...], start: list[float], numeric: list[str] | None = None,
            categories: list[tuple[str, int]] | None = None) -> Prepared | None:
    """Code rows of ``(features, y, w, held)`` by the thresholds of those that are not held; None without such a row.

    ``numeric`` and ``categories`` name the columns that the features were assembled from, in their order: numbers, then
    category numbers with how many one-hot features each has (a number past them has none). Vectors are not read then.
    """
    x = vector_to_array("features") if numeric is None else F.array(*numeric).cast("array<double>")
    c = F.array(*[F.col(name).cast("int") for name, _ in categories or []]).cast("array<int>")
    source = rows.where("w > 0").select(x.alias("x"), c.alias("c"), "y", "w", "held")
    learned = source.where("not held").select("x", "w")
    first = learned.first()
    if first is None:
        return None
    columns, width = [Coded(i, len(t) + 1, t) for i, t in thresholds(learned).items()], len(first.x)
    for _, values in categories or []:
        columns.append(Coded(width, values + 1))
        width += values
    return Prepared(columns, width, stage(blocks(stage(binned(source, columns), "binned"), columns, classes, start), "blocks"))


def grow(prepared: Prepared, classes: tuple[int, ...], rounds: int, depth: int, step: float, child: float, least: float,
         rate: float = 1.0, strategy: str = "1.0", seed: int = 0, patience: int | None = None) -> tuple[list[list[DecisionTreeRegressionModel]], list[float]]:
    """Trees by round and class, and the loss of the held-out rows after each round if ``patience`` is given.

    ``child`` is the least sum of curvatures in a leaf, ``least`` the least curvature of a row. A tree learns from a share
    ``rate`` of the rows, a node may ask the features that ``strategy`` lets it draw. Boosting stops when the loss has not
    improved for ``patience`` rounds.
    """
    columns, state, pending, out, losses = prepared.columns, prepared.state, [], [], []
    asked = features_a_node(strategy, prepared.width)
    for number in range(rounds):
        trees = [Tree() for _ in classes]
        nodes = [[0] for _ in classes]  # open ones of each class
        seeds = [[seed % (1 << 63), number * len(classes) + k] for k in range(len(classes))]
        draws = [int(np.random.default_rng(s).integers(1 << 63)) for s in seeds]
        for level in range(depth):
            sums = added_up(_level(state, pending, trees, nodes, columns, step, least, rate, draws))
            for k, tree in enumerate(trees):
                found = sums[k].reshape(len(nodes[k]), -1, 3) if nodes[k] else []
                if level == 0:
                    tree.stats[0] = found[0, 0]
                    smallest = [min(0.49 * tree.stats[0][0], child)] if k == 0 else [*smallest, min(0.49 * tree.stats[0][0], child)]
                opened = []
                for node, table in zip(nodes[k], found):
                    best = _best(table, columns, smallest[k], drawn_features(prepared.width, asked, [*seeds[k], node]))
                    if best is not None:
                        opened += [n for n in tree.split(node, *best) if impurity(tree.stats[n]) > np.finfo(float).eps]
                nodes[k] = opened
            if not any(nodes):
                break
        pending.append(trees)
        out.append([_model(tree, columns, prepared.width) for tree in trees])
        if patience is not None:
            losses.append(_loss(state, pending, columns, step))
            if len(losses) - 1 - min(range(len(losses)), key=losses.__getitem__) >= patience:
                break
        if len(pending) == STORED_EVERY and len(out) < rounds:
            state, pending = stage(_added(state, pending, columns, step), "blocks"), []
    return out, losses


def features_a_node(strategy: str, width: int) -> int:
    """How many features a node draws, as the library reads its ``featureSubsetStrategy`` for a single tree."""
    named = {"auto": width, "all": width, "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(max(1, width)))), "onethird": math.ceil(width / 3)}
    if strategy in named:
        return named[strategy]
    try:
        return min(int(strategy), width)
    except ValueError:
        return math.ceil(float(strategy) * width)


def drawn_features(width: int, number: int, seed: list[int]) -> np.ndarray | None:
    """Marks of the features that a node may ask; None for all of them."""
    if number >= width:
        return None
    marks = np.zeros(width, bool)
    marks[np.random.default_rng(seed).choice(width, number, replace=False)] = True
    return marks


def _kind(columns: list[Coded]) -> np.dtype:
    """The smallest type that holds every code."""
    return np.min_scalar_type(max([c.size for c in columns], default=1) - 1)


def _codes(table: pa.Table, kind: np.dtype) -> np.ndarray:
    """A row per column."""
    column = table.column("codes").combine_chunks().cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    codes = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(kind)
    return np.ascontiguousarray(codes.reshape(len(column), -1).T)


def _added(state: DataFrame, pending, columns: list[Coded], step: float) -> DataFrame:
    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in read_parts(batches, columns, len(pending[0])):
            yield replace(part, margins=part.moved(pending, step)).records()

    return state.mapInArrow(moved, BLOCK)


def _shares(margins: np.ndarray) -> np.ndarray:
    shares = np.exp(margins - margins.max(axis=0))
    shares /= shares.sum(axis=0)
    return shares


def _loss(state: DataFrame, pending, columns: list[Coded], step: float) -> float:
    """Mean negative log, by weight, of the probability that a held-out row's class got; infinite without such a row."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss = weight = 0.0
        for part in read_parts(batches, columns, len(pending[0])):
            shares = _shares(part.moved(pending, step))
            p = np.where(part.y < 0, 0.0, shares[part.y, np.arange(len(part.y))])
            loss -= float((np.log(np.maximum(p, 1e-15)) * part.w).sum())
            weight += float(part.w.sum())
        yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([weight])], ["loss", "weight"])

    total = state.where("held").mapInArrow(partial, "loss double, weight double").agg(F.sum("loss").alias("loss"), F.sum("weight").alias("weight")).first()
    return total.loss / total.weight if total.weight else math.inf


def _grouped(sizes: list[int], most: int) -> list[list[int]]:
    """Neighbouring columns that have at most ``most`` cells together; a larger column is alone."""
    groups, cells = [], 0
    for f, size in enumerate(sizes):
        if groups and cells * size <= most:
            groups[-1].append(f)
            cells *= size
        else:
            groups.append([f])
            cells = size
    return groups


def _level(state: DataFrame, pending, trees: list[Tree], nodes: list[list[int]], columns: list[Coded], step: float, least: float,
           rate: float, draws: list[int]) -> DataFrame:
    """Per class, partial sums by open node: the node's own, then those of every code of every column."""
    sizes = [c.size for c in columns]
    groups = _grouped(sizes, CELLS // max(1, *map(len, nodes)))
    cells = [math.prod(sizes[f] for f in group) for group in groups]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {k: np.zeros((3, len(open_))) for k, open_ in enumerate(nodes) if open_}
        total = {k: [np.zeros((3, len(nodes[k]) * n)) for n in cells] for k in own}
        for part in read_parts(batches, columns, len(nodes)):
            shares, w = _shares(part.moved(pending, step)), part.w
            together = [_together(part.codes, sizes, group) for group in groups]
            for k in own:
                place = np.full(len(trees[k].column), -1)
                place[nodes[k]] = np.arange(len(nodes[k]))
                at, counted = place[trees[k].reached(part.codes)], together
                curve = np.maximum(shares[k] * (1 - shares[k]), least)
                slope = (part.y == k) - shares[k]
                stats, open_ = [w * curve, w * slope, w * slope * slope / curve], at >= 0
                if rate < 1:
                    open_ &= part.drawn(rate, draws[k])
                if not open_.all():
                    kept = np.flatnonzero(open_)
                    at, stats, counted = at[kept], [s[kept] for s in stats], [t[kept] for t in together]
                _count(own[k], at, stats)
                for sums, n, codes in zip(total[k], cells, counted):
                    _count(sums, at * n + codes, stats)
        yield packed({k: _by_column(own[k], total[k], sizes, groups) for k in own})

    return state.where("not held").mapInArrow(partial, "number int, sums binary")


def _together(codes: np.ndarray, sizes: list[int], group: list[int]) -> np.ndarray:
    """One number for the codes of several columns."""
    out = codes[group[0]].astype(np.intp)
    for f in group[1:]:
        out *= sizes[f]
        out += codes[f]
    return out


def _count(sums: np.ndarray, cell: np.ndarray, stats: list[np.ndarray]) -> None:
    for j, s in enumerate(stats):
        sums[j] += np.bincount(cell, weights=s, minlength=sums.shape[1])


def _by_column(own: np.ndarray, total: list[np.ndarray], sizes: list[int], groups: list[list[int]]) -> np.ndarray:
    """Sums of a class by node: its own, then those of every code of every column."""
    n, parts = own.shape[1], [own[:, :, None]]
    for sums, group in zip(total, groups):
        shaped = sums.reshape(3, n, *[sizes[f] for f in group])
        parts += [shaped.sum(axis=tuple(2 + j for j in range(len(group)) if j != i)) for i in range(len(group))]
    return np.ascontiguousarray(np.concatenate(parts, axis=2).transpose(1, 2, 0))


def _best(table: np.ndarray, columns: list[Coded], smallest: float, drawn: np.ndarray | None = None):
    """The split of a node with the largest gain, the first among equals: column, cut, whether the cut is a category's value,
    gain, sums to its left and right. ``drawn`` marks the features that may be asked."""
    whole, lo, best = table[0], 1, None
    spread = impurity(whole)
    for f, column in enumerate(columns):
        inner, lo = table[lo:lo + column.size - 1], lo + column.size
        if not len(inner):
            continue
        if column.limits is None:
            right = inner
            left = whole - right
        else:
            left = np.cumsum(inner, axis=0)
            right = whole - left
        fits = (left[:, 0] >= smallest) & (right[:, 0] >= smallest) & (left[:, 0] > 0) & (right[:, 0] > 0)
        if drawn is not None:
            fits &= drawn[column.first:column.first + (len(inner) if column.limits is None else 1)]
        gain = np.where(fits, spread - (left[:, 0] * impurity(left) + right[:, 0] * impurity(right)) / whole[0], -np.inf)
        cut = int(np.argmax(gain))
        if gain[cut] > max(1e-12 * spread, best[3] if best else 0.0):
            best = (f, cut, column.limits is None, float(gain[cut]), left[cut], right[cut])
    return best


def _model(tree: Tree, columns: list[Coded], width: int) -> DecisionTreeRegressionModel:
    """The tree as the library's model."""
    from pyspark import SparkContext
    from pyspark.ml.util import Identifiable

    sc = SparkContext._active_spark_context
    ml, mllib = sc._jvm.org.apache.spark.ml, sc._jvm.org.apache.spark.mllib

    def built(node: int):
        stats = tree.stats[node]
        held = sc._gateway.new_array(sc._gateway.jvm.double, 3)
        for i, value in enumerate(stats):
            held[i] = float(value)
        kept = mllib.tree.impurity.VarianceCalculator(held, int(round(stats[0])))
        value, spread = float(stats[1] / stats[0]) if stats[0] else 0.0, float(impurity(stats))
        if tree.column[node] < 0:
            return ml.tree.LeafNode(value, spread, kept)
        column, cut = columns[tree.column[node]], tree.cut[node]
        split = ml.tree.ContinuousSplit(column.first + cut, 0.5) if tree.only[node] else ml.tree.ContinuousSplit(column.first, float(column.limits[cut]))
        return ml.tree.InternalNode(value, spread, tree.gain[node], built(tree.left[node]), built(tree.right[node]), split, kept)

    uid = Identifiable._randomUID.__func__(DecisionTreeRegressionModel)
    return DecisionTreeRegressionModel(ml.regression.DecisionTreeRegressionModel(uid, built(0), width))
