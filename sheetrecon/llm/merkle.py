"""Merkle manifest of a dataset as a postorder append log (operator 13).

Rows are leaves, ordered within their source; every three consecutive nodes
hash to one node of the next level until one is left. Aligned builders (blocks
of 3 ** LEVELS leaves) hash whole subtrees on their own and append the nodes to
their segment of the log in the order in which they complete. The roots of the
blocks are the leaves of the next tier, up to the subroot of the source; the
subroots form the top tree in the same way.

No node stores a pointer: the place of node ``i`` of level ``l`` follows from the
sizes of the subtrees that complete before it (``place``), so a proof reads its
siblings out of one segment per tier.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batched, materialize
from .near import grouped

#: Levels that a builder completes; it takes 3 ** LEVELS leaves.
LEVELS, FAN = 7, 3
#: Bytes of a digest.
WIDE = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "tree string, n long, block long, log binary, root binary"


def completed(leaves: int) -> int:
    """Nodes that are complete when that many leaves (not the last one) are in: the
    leaves, and the subtrees of three, nine, ... of them."""
    total = 0
    while leaves:
        total += leaves
        leaves //= FAN
    return total


def place(level: int, index: int, n: int) -> int:
    """Postorder position of node ``index`` of ``level`` in a tree of ``n`` leaves: a
    node completes with its last leaf, after the nodes below it."""
    return completed(min((index + 1) * FAN ** level, n) - 1) + level


def height(n: int) -> int:
    """Levels above the leaves until one node is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def h(parts) -> bytes:
    """Hex digest of the hex digests ``parts``."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def append_log(leaves: list[bytes], levels: int) -> bytes:
    """The digests of the ``levels`` levels over ``leaves`` (hex), in the order in which
    they complete."""
    n = len(leaves)
    log = bytearray(WIDE * (place(levels, 0, n) + 1))
    nodes = leaves
    for level in range(levels + 1):
        for i, x in enumerate(nodes):
            at = WIDE * place(level, i, n)
            log[at:at + WIDE] = bytes.fromhex(x.decode())
        if level < levels:
            nodes = [h(nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)]
    return bytes(log)


@dataclass(frozen=True)
class Blocks:
    """Aligned blocks of ``FAN ** levels`` nodes."""

    levels: int = LEVELS

    @property
    def run(self) -> int:
        return FAN ** self.levels

    def height(self, n: int) -> int:
        """Levels of a block in a tier of ``n`` nodes: a whole builder's, unless one
        block holds them all."""
        return height(n) if n <= self.run else self.levels

    def siblings(self, n: int, block: int, log: bytes) -> "Siblings":
        return Siblings(log, min(self.run, n - block * self.run), self.height(n))


@dataclass
class Siblings:
    """Reads siblings out of a segment."""

    log: bytes
    n: int
    levels: int

    def node(self, level: int, index: int) -> bytes:
        at = WIDE * place(level, index, self.n)
        return self.log[at:at + WIDE].hex().encode()

    def paths(self) -> list[list[tuple[bytes, bytes]]]:
        """For every leaf the digests left and right of the nodes above it, by level;
        what lies above a run is read once."""
        above, size, sizes = [[]], self.n, [self.n]
        for _ in range(self.levels):
            size = -(-size // FAN)
            sizes.append(size)
        for level in reversed(range(self.levels)):
            nodes = [self.node(level, i) for i in range(sizes[level])]
            above = [[(b"".join(nodes[i // FAN * FAN:i]), b"".join(nodes[i + 1:i // FAN * FAN + FAN])),
                      *above[i // FAN]] for i in range(sizes[level])]
        return above


def packed(path: list[tuple[bytes, bytes]]) -> bytes:
    return b"|".join(left + b"," + right for left, right in path)


def unpacked(path: bytes) -> list[tuple[bytes, bytes]]:
    return [tuple(p.split(b",")) for p in path.split(b"|")] if path else []


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    for left, right in path:
        leaf = h((left, leaf, right))
    return leaf


def item(value: Column) -> Column:
    """``-`` for null, else the byte count of the value as text, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[item(f) for f in fields]), 256))


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Rows tree, doc_id, leaf and ``changed``: the leaf with ``tampered`` as the text
    where that is another text, else null. A null source is a tree of its own."""
    cols = [F.col(f"`{c}`") for c in FIELDS]
    changed = F.lit(None).cast("binary") if tampered is None else F.when(
        tampered != cols[-1], leaf_of([*cols[:-1], tampered]))
    return materialize(batched(docs).select(
        F.coalesce(F.concat(F.lit("s"), cols[1]), F.lit("-")).alias("tree"), cols[0].alias("doc_id"),
        leaf_of(cols).alias("leaf"), changed.alias("changed")), "leaves")


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, ...) with ``pos``, the place within the tree (from 0) in ``order``
    (nulls first; equal rows in any order), and ``n``, the size of the tree.

    Rows are range-partitioned on the whole order, so a tree that holds most rows lies
    in many partitions; only a count for each partition and tree is summed up.
    """
    order = [F.col(c).asc_nulls_first() for c in ("tree", *order, "tie")]
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("tie")
            .withColumn("part", F.spark_partition_id())
            .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    rows = materialize(rows, "ordered")
    counts = rows.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("tree", "part", F.sum("n").over(tree).alias("n"),
                           (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    return (rows.join(counts, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift"))
            .drop("part", "at", "shift"))


def segments(nodes: DataFrame, with_docs: bool, blocks: Blocks) -> DataFrame:
    """nodes (tree, n, pos, leaf) -> one row per aligned block with its segment of the
    log; with ``with_docs`` also the block's doc_id and changed leaves, in order."""
    def run(batches):
        for block in grouped(batches, "block_key", 1):
            tree, n, at = (block.column(c)[0].as_py() for c in ("tree", "n", "pos"))
            found = [x.hex().encode() for x in block.column("leaf").to_pylist()]
            log = append_log(found, blocks.height(n))
            row = {"tree": [tree], "n": [n], "block": [at // blocks.run], "log": [log], "root": [log[-WIDE:]]}
            if with_docs:
                row["doc_id"] = pa.array([block.column("doc_id").to_pylist()], pa.list_(pa.int64()))
                row["changed"] = pa.array([block.column("changed").to_pylist()], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_pydict(row)

    schema = SEGMENT + (", doc_id array<long>, changed array<binary>" if with_docs else "")
    key = F.concat("tree", F.lit(" "), F.expr(f"pos div {blocks.run}").cast("string"))
    return (nodes.withColumn("block_key", key).repartition("block_key")
            .sortWithinPartitions("block_key", "pos").mapInArrow(run, schema))


@dataclass
class Manifest:
    """Segments by tier of all source trees (tier 0 holds the documents) and of the top
    tree; ``roots`` has tree, subroot and root."""

    blocks: Blocks
    tiers: list[DataFrame]
    top: list[DataFrame]
    roots: DataFrame


def tiers_of(nodes: DataFrame, with_docs: bool, blocks: Blocks) -> tuple[list[DataFrame], DataFrame]:
    """The segments of each tier, and the root of each tree (tree, root)."""
    tiers, roots, run = [], None, blocks.run
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        tier = materialize(segments(nodes, with_docs and not tiers, blocks), "segments")
        tiers.append(tier)
        ended = tier.where(F.col("n") <= run).select("tree", "root")
        roots = ended if roots is None else roots.unionByName(ended)
        if most <= run:
            return tiers, roots
        most = -(-most // run)
        nodes = tier.where(F.col("n") > run).select(
            "tree", F.expr(f"(n + {run - 1}) div {run}").alias("n"), F.col("block").alias("pos"), F.col("root").alias("leaf"))


def build(found: DataFrame, levels: int = LEVELS) -> Manifest:
    """The manifest of ``leaves``, by builders of ``levels`` levels."""
    blocks = Blocks(levels)
    tiers, subroots = tiers_of(positions(found, ["doc_id", "leaf"]), True, blocks)
    subroots = materialize(subroots, "subroots")
    named = positions(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"),
                                      F.col("root").alias("leaf")), ["name"])
    named = materialize(named, "sources")
    top, root = tiers_of(named, False, blocks)
    roots = named.join(root, "tree").select(F.col("name").alias("tree"), F.col("leaf").alias("subroot"),
                                            "root", "pos")
    return Manifest(blocks, tiers, top, roots)


def unfolded(tiers: list[DataFrame], paths: DataFrame, blocks: Blocks) -> DataFrame:
    """paths (tree, path) of whole trees -> (tree, block, path) of every block of the
    lowest tier: each tier adds the siblings that its segments hold."""
    def run(batches):
        for batch in batches:
            for tree, n, block, log, path in zip(*(batch.column(c).to_pylist() for c in
                                                   ("tree", "n", "block", "log", "path"))):
                inside, rest = blocks.siblings(n, block, log).paths(), unpacked(path)
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array([tree] * len(inside), pa.string()),
                    "block": pa.array(np.arange(len(inside)) + block * blocks.run),
                    "path": pa.array([packed([*p, *rest]) for p in inside], pa.binary())})

    paths = paths.select("tree", F.lit(0).cast("long").alias("block"), "path")
    below = paths.where(F.lit(False))
    for tier in reversed(tiers[1:]):
        ends = tier.where(F.col("n") <= blocks.run).select("tree").distinct()
        here = paths.join(ends, "tree", "left_semi").unionByName(below)
        below = materialize(tier.join(here, ["tree", "block"]).mapInArrow(
            run, "tree string, block long, path binary"), "paths")
    ends = tiers[0].where(F.col("n") <= blocks.run).select("tree").distinct()
    return paths.join(ends, "tree", "left_semi").unionByName(below)


def proofs(manifest: Manifest) -> DataFrame:
    """Row per document: doc_id, leaf, subroot, root, proof_sha256 (of its siblings in
    order), folded_root (the changed leaf, or its own, folded with the siblings)."""
    blocks = manifest.blocks

    def top(batches):
        for batch in batches:
            for n, block, log, path in zip(*(batch.column(c).to_pylist() for c in ("n", "block", "log", "path"))):
                inside, rest = blocks.siblings(n, block, log).paths(), unpacked(path)
                yield pa.RecordBatch.from_pydict({
                    "pos": pa.array(np.arange(len(inside)) + block * blocks.run),
                    "path": pa.array([packed([*p, *rest]) for p in inside], pa.binary())})

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                inside, rest = blocks.siblings(row["n"], row["block"], row["log"]), unpacked(row["path"])
                rest_hex = b"".join(left + right for left, right in rest)
                own, paths = [inside.node(0, i) for i in range(inside.n)], inside.paths()
                folded = [fold(x.hex().encode() if x else leaf, [*p, *rest])
                          for leaf, x, p in zip(own, row["changed"], paths)]
                proof = [h([*(left + right for left, right in p), rest_hex]) for p in paths]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(row["doc_id"], pa.int64()), "leaf": [x.decode() for x in own],
                    "proof_sha256": [x.decode() for x in proof], "folded_root": [x.decode() for x in folded],
                    "subroot": [row["subroot"]] * len(own), "root": [row["whole"]] * len(own)})

    above = unfolded(manifest.top, manifest.roots.select(F.lit("").alias("tree"),
                                                         F.lit(b"").alias("path")).distinct(), blocks)
    sources = manifest.top[0].join(above, ["tree", "block"]).mapInArrow(top, "pos long, path binary")
    named = materialize(manifest.roots.join(sources, "pos"), "roots")
    # the roots join the narrow paths: rows of documents are never dealt by source
    below = unfolded(manifest.tiers, named.select("tree", "path"), blocks).join(
        named.select("tree", F.lower(F.hex("subroot")).alias("subroot"), F.lower(F.hex("root")).alias("whole")), "tree")
    rows = manifest.tiers[0].drop("root").join(below, ["tree", "block"])
    return rows.mapInArrow(run, "doc_id long, leaf string, proof_sha256 string, folded_root string, "
                                "subroot string, root string")


def verified(docs: DataFrame, tampered: Column, levels: int = LEVELS) -> DataFrame:
    """Row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root and
    verified (the proof of the row, with ``tampered`` as its text, leads to the root).

    Nulls count as ``-`` in the leaf; a null source is a tree of its own (first), null
    ids come first in their source. Rows of one id in one source are ordered by their
    leaf; equal rows have a leaf each. A null ``tampered`` leaves the text as it is. An
    empty table gives an empty result. Other columns are ignored.
    """
    rows = proofs(build(leaves(docs, tampered), levels))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))
