"""Merkle manifest of a dataset by time-forward processing.

A row's leaf is the digest of its fields. The leaves of a group, in order of id, are hashed run by run of ``ARITY``
until one node is left, the group's subroot; subroots are hashed alike to the root.

Nodes are labelled so that children come before their parent: by the last leaf below them, then by height. A forward sweep
visits labels in ascending order; a priority queue ordered by label hands a node the digests that its children sent. The
queue is external: subtrees of ``ARITY ** BAND`` nodes are the units of Spark's sorted shuffle, which brings messages in
label order, and a heap holds those sent within a subtree, fewer than ``ARITY`` a level. What a subtree's top sends goes
into the next shuffle, so a sweep climbs ``BAND`` levels. The reversed sweep visits labels in descending order: a node
gets the suffix of the proofs below it from its parent, puts each child's siblings before it and sends it on; the leaves'
proofs are used where they arrive, none travels through a shuffle.

Leaves are numbered by ranges of (group, id), so a group of any size is spread over tasks. The driver holds a row count per
range and the root.

Defined cases: nulls are ``-`` in any field; a null id comes first in its group, a null group is a group, the first; rows
that share group and id are ordered by leaf, so equal rows stand together; an empty table has no root and gives no row; only
the named columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayworks.llm.common import runs, stage

ARITY = 16
BAND = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SIZE = 32


def leaf_digest(fields: list[Column]) -> Column:
    """Binary SHA-256 of the fields, each ``-`` if null, else its number of UTF-8 bytes, a colon and its value."""
    shown = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in shown]).cast("binary"), 256))


def hashed(digests: list[bytes]) -> bytes:
    """A parent's digest: over the hex text of its children."""
    return sha256(b"".join(digests).hex().encode()).digest()


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds ``rank``, the row's number from 0 in this order, nulls first; ``df`` is read twice: pass a stored table."""
    tied = df.withColumn("tie", F.monotonically_increasing_id())
    sort = [*order, "tie"]
    ranged = stage(tied.repartitionByRange(*sort).sortWithinPartitions(*sort).drop("tie")
                   .withColumn("at", F.monotonically_increasing_id()), name)
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    held = sorted((r.part, r.n) for r in ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    bases = df.sparkSession.createDataFrame(
        [(p, b) for (p, _), b in zip(held, accumulate((n for _, n in held), initial=0))], "part long, base long")
    return ranged.withColumn("part", part).join(bases, "part").withColumn("rank", F.col("base") + row).drop("part", "base", "at")


@dataclass
class Shape:
    arity: int = ARITY
    band: int = BAND

    @property
    def block(self) -> int:
        return self.arity ** self.band

    def height(self, n: int) -> int:
        """Levels that a sweep climbs above ``n`` nodes: to the single one or to the end of the band."""
        levels = 0
        while n > 1 and levels < self.band:
            n, levels = -(-n // self.arity), levels + 1
        return levels

    def end(self, node: int, level: int, n: int) -> int:
        """One past the last leaf below a node."""
        return min((node + 1) * self.arity ** level, n)


@dataclass
class Tree:
    """Nodes every ``band`` levels, lowest first: ``tree, idx`` (in its level), ``n`` (nodes of its level), ``digest``, others."""

    bands: list[DataFrame]
    roots: DataFrame  # tree, digest


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    for rows, at in runs(batches, ["tree", "block"]):
        for lo, hi in zip(at, at[1:]):
            if hi > lo:
                yield rows.slice(lo, hi - lo).to_pydict()


def forward(digests: list[bytes], first: int, n: int, shape: Shape) -> tuple[bytes, dict[tuple[int, int], list[bytes]]]:
    """The digest of a subtree's top and what each of its nodes, by label, got from its children."""
    top = shape.height(n)
    queue: list[tuple[int, int, int, bytes]] = []  # label of the receiver (end, level), number of the sender, digest
    received: dict[tuple[int, int], list[bytes]] = {}

    def send(node: int, level: int, digest: bytes) -> None:
        heapq.heappush(queue, (shape.end(node // shape.arity, level + 1, n), level + 1, node, digest))

    if top == 0:
        return digests[0], received
    for i, leaf in enumerate(digests, first):
        send(i, 0, leaf)
        while queue and queue[0][0] <= i + 1:
            end, level, sender, digest = heapq.heappop(queue)
            children = [digest]
            while queue and queue[0][:2] == (end, level):
                children.append(heapq.heappop(queue)[3])
            received[end, level] = children
            if level == top:
                return hashed(children), received
            send(sender // shape.arity, level, hashed(children))
    raise ValueError("a subtree lacks leaves")


def backward(digests: list[bytes], first: int, n: int, shape: Shape, suffix) -> Iterator[tuple[int, tuple]]:
    """Each leaf's number and proof: nested ``(slot, run of digests, proof of the parent)``; leaves in descending order."""
    top, received = shape.height(n), forward(digests, first, n, shape)[1]
    queue = [(-shape.end(first // shape.arity ** top, top, n), -top, first // shape.arity ** top, suffix)]
    while queue:
        end, level, node, suffix = heapq.heappop(queue)
        if level == 0:
            yield node, suffix
            continue
        run = received[-end, -level]
        for slot in range(len(run)):
            child = node * shape.arity + slot
            heapq.heappush(queue, (-shape.end(child, -level - 1, n), level + 1, child, (slot, run, suffix)))


def climb(nodes: DataFrame, most: int, shape: Shape) -> Tree:
    """All levels that end a band above stored ``nodes``, the largest tree of which has ``most``."""
    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            top, _ = forward(b["digest"], b["idx"][0], b["n"][0], shape)
            yield pa.RecordBatch.from_pylist([{"tree": b["tree"][0], "idx": b["block"][0], "n": -(-b["n"][0] // shape.block), "digest": top}],
                                             pa.schema([("tree", pa.int64()), ("idx", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())]))

    bands, roots = [nodes], nodes.where("n = 1").select("tree", "digest")
    while most > 1:
        units = (bands[-1].where("n > 1").select("tree", F.floor(F.col("idx") / shape.block).alias("block"), "idx", "n", "digest")
                 .repartition("tree", "block").sortWithinPartitions("tree", "block", "idx"))
        bands.append(stage(units.mapInArrow(up, "tree long, idx long, n long, digest binary"), "merkle-level"))
        roots = roots.unionAll(bands[-1].where("n = 1").select("tree", "digest"))
        most = -(-most // shape.block)
    return Tree(bands, roots)


def packed(proof: tuple | None) -> bytes:
    """A proof as bytes: per level the slot, the size of the run less one, and the run's digests."""
    out = []
    while isinstance(proof, tuple):
        slot, run, proof = proof
        out.append(bytes((slot, len(run) - 1)) + b"".join(run))
    return b"".join(out) + (proof or b"")


def levels(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(path):
        slot, size = path[at], path[at + 1] + 1
        yield slot, [path[at + 2 + SIZE * i:at + 2 + SIZE * (i + 1)] for i in range(size)]
        at += 2 + SIZE * size


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and the siblings of its proof give."""
    for slot, run in levels(path):
        leaf = hashed([*run[:slot], leaf, *run[slot + 1:]])
    return leaf


def descend(tree: Tree, suffixes: DataFrame, shape: Shape, finish, kinds: str, schema: pa.Schema) -> DataFrame:
    """Send each tree's suffix (``tree, head, suffix``) down to its leaves; ``finish`` makes an output row there."""
    def down(last: bool):
        def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in blocks(batches):
                head, suffix = b["head"][0], b["suffix"][0]  # the message of the parent is the first row
                digests, first, n = b["digest"][1:], b["idx"][1], b["n"][1]
                out, begun = [], finish(head, suffix) if last else None
                for i, proof in backward(digests, first, n, shape, suffix):
                    k = i - first
                    if last:
                        out.append(begun(b["id"][k + 1], digests[k], b["claim"][k + 1], proof))
                    else:
                        out.append({"tree": b["tree"][0], "block": i, "head": head, "suffix": packed(proof)})
                for lo in range(0, len(out), 512):
                    yield pa.RecordBatch.from_pylist(out[lo:lo + 512], schema if last else sent)

        return swept

    sent = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("head", pa.binary()), ("suffix", pa.binary())])
    above = None
    for number in range(len(tree.bands) - 1, -1, -1):
        nodes = tree.bands[number]
        if "claim" not in nodes.columns:
            nodes = nodes.withColumns({"id": F.lit(None).cast("string"), "claim": F.lit(None).cast("binary")})
        tops = nodes.where("n = 1").join(suffixes, "tree").select("tree", F.lit(0).cast("long").alias("block"), "head", "suffix")
        tops = tops if above is None else tops.unionAll(above)
        rows = nodes.select("tree", F.floor(F.col("idx") / shape.block).alias("block"), "idx", "n", "digest", "id", "claim").unionByName(
            tops.withColumn("idx", F.lit(-1).cast("long")), allowMissingColumns=True)
        units = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")
        above = units.mapInArrow(down(number == 0), kinds if number == 0 else "tree long, block long, head binary, suffix binary")
    return above


@dataclass
class Manifest:
    leaves: Tree | None  # lowest band: tree, idx, n, digest, id, claim
    subroots: Tree | None
    groups: DataFrame  # tree (its number in order), grp, n
    root: bytes | None
    shape: Shape


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
          claimed: dict[str, Column] | None = None, arity: int = ARITY, band: int = BAND) -> Manifest:
    """The manifest of ``docs``. ``claimed`` replaces fields by what is to be checked against it (see :func:`audit`)."""
    shape = Shape(arity, band)
    leaf = leaf_digest([F.col(f) for f in fields])
    claim = leaf_digest([(claimed or {}).get(f, F.col(f)) for f in fields]) if claimed else F.lit(None).cast("binary")
    leaves = stage(docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), leaf.alias("digest"), claim.alias("claim")), "leaves")
    ranked = numbered(leaves, ["grp", "id", "digest"], "ranked")
    counted = stage(ranked.groupBy("grp").agg(F.min("rank").alias("first"), F.count("*").alias("n")), "groups")
    groups = numbered(counted, ["first"], "ordered-groups").withColumnRenamed("rank", "tree")
    most, trees = counted.agg(F.coalesce(F.max("n"), F.lit(0)), F.count("*")).first()
    if not trees:
        return Manifest(None, None, groups, None, shape)
    g = groups.withColumnRenamed("grp", "grp_")
    nodes = stage(ranked.join(g, ranked["grp"].eqNullSafe(g["grp_"]))
                  .select("tree", (F.col("rank") - F.col("first")).alias("idx"), "n", "digest", "id", "claim"), "merkle-leaves")
    below = climb(nodes, most, shape)
    tops = stage(below.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(trees).cast("long").alias("n"), "digest"),
                 "subroots")
    above = climb(tops, trees, shape)
    return Manifest(below, above, groups, bytes(above.roots.first().digest), shape)


def _suffixes(m: Manifest) -> DataFrame:
    """Per group: its subroot as ``head``, and the proof of the subroot."""
    spark = m.groups.sparkSession
    start = spark.createDataFrame([(0, bytearray(), bytearray())], "tree long, head binary, suffix binary")
    below = Tree([m.subroots.bands[0].withColumns({"id": F.col("idx"), "claim": F.lit(None).cast("binary")}), *m.subroots.bands[1:]], m.subroots.roots)
    schema = pa.schema([("tree", pa.int64()), ("head", pa.binary()), ("suffix", pa.binary())])

    def finish(head, suffix):
        return lambda i, leaf, claim, proof: {"tree": i, "head": leaf, "suffix": packed(proof)}

    return stage(descend(below, start, m.shape, finish, "tree long, head binary, suffix binary", schema), "subroot-proofs")


def _per_leaf(m: Manifest, finish, columns: dict[str, tuple[str, pa.DataType]], docs_id: str = "long") -> DataFrame:
    kinds = ", ".join(f"{c} {k}" for c, (k, _) in columns.items())
    schema = pa.schema([(c, k) for c, (_, k) in columns.items()])
    if m.root is None:
        return m.groups.sparkSession.createDataFrame([], kinds)
    return descend(m.leaves, _suffixes(m), m.shape, finish, kinds, schema)


def _id_column(m: Manifest) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = m.leaves.bands[0].schema["id"].dataType if m.leaves else None
    return (kind.simpleString(), to_arrow_type(kind)) if kind else ("long", pa.int64())


def proofs(m: Manifest) -> DataFrame:
    """``id, leaf, subroot, root, proof``: the proof as :func:`levels` reads it."""
    root = m.root

    def finish(head, suffix):
        return lambda i, leaf, claim, proof: {"id": i, "leaf": leaf, "subroot": head, "root": root, "proof": packed(proof)}

    binary = ("binary", pa.binary())
    return _per_leaf(m, finish, {"id": _id_column(m), "leaf": binary, "subroot": binary, "root": binary, "proof": binary})


def audit(m: Manifest) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified``: the root folded from the claimed leaf and the proof.

    Digests are lowercase hex; ``proof_sha256`` is over the siblings' hex text, lowest level first, left to right.
    """
    root = m.root.hex() if m.root else None
    text = SIZE * 2

    def finish(head, suffix):
        subroot, above = head.hex(), [(slot, b"".join(run).hex().encode()) for slot, run in levels(suffix or b"")]
        known: dict[int, bytes] = {}

        def row(i, leaf, claim, proof):
            digest, now = sha256(), (claim or leaf).hex().encode()
            way = []
            while isinstance(proof, tuple):
                slot, run, proof = proof
                if id(run) not in known:
                    known[id(run)] = b"".join(run).hex().encode()
                way.append((slot, known[id(run)]))
            for slot, run in (*way, *above):
                left, right = run[:slot * text], run[(slot + 1) * text:]
                digest.update(left + right)
                now = sha256(left + now + right).hexdigest().encode()
            folded = now.decode()
            return {"id": i, "leaf": leaf.hex(), "subroot": subroot, "root": root, "proof_sha256": digest.hexdigest(),
                    "folded_root": folded, "verified": folded == root}

        return row

    string = ("string", pa.string())
    return _per_leaf(m, finish, {"id": _id_column(m), "leaf": string, "subroot": string, "root": string, "proof_sha256": string,
                                 "folded_root": string, "verified": ("boolean", pa.bool_())})
