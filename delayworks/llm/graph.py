"""Connected components of an edge table by alternating stars, every round written to the shared folder."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.llm.common import stage


def merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hook the larger root of each pair under the smaller one until every pair has one root."""
    while True:
        p, q = root[a], root[b]
        differ = p != q
        if not differ.any():
            return root
        np.minimum.at(root, np.maximum(p, q)[differ], np.minimum(p, q)[differ])
        while (root != root[root]).any():
            root = root[root]


def components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge, the component being its smallest node.

    Large-star links a node's larger neighbours to its smallest, small-star does so for the smaller ones; both keep what
    is connected, and alternate until the edges form stars. A node's neighbours are only ever reduced to their minimum,
    so a hub costs a partial aggregate and a join that can be split, never a collected list.
    """
    current = stage(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a <> b")
                    .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        large = stage(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        linked = large.join(low, "a")
        small = (linked.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .unionAll(low.select("a", F.col("low").alias("b"))).distinct())
        current = stage(small, "small-star")
        # stars do not change any more: same edges as after the round before
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionAll(roots)
