"""Pairs of 64-bit fingerprints within a few bits, and connected groups.

* ``cells``: pigeonhole keys. The 64 bits are cut into ``radius + pick`` blocks;
  two fingerprints that differ in at most ``radius`` bits agree on at least
  ``pick`` of them, so they meet under one combination of ``pick`` blocks.
  A key with more than CELL fingerprints is cut into chunks, and every pair of
  chunks is a cell of its own: no cell grows, no pair is lost.
* ``bit_sliced``: all distances inside a cell by vertical bit planes and
  carry-save counters.
* ``components``: connected groups by large-star / small-star rounds, each
  written to the shared folder, and the round before deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, release

#: Fingerprints in one chunk of a hot key; a cell holds two chunks at most.
CELL = 1024
#: One fingerprint in so many estimates the sizes of keys.
SAMPLE = 64
#: Cells of up to so many rows may be compared many at a time.
SMALL = 64
BITS = (1 << 64) - 1
ALL = np.uint64(BITS)


def block_masks(radius: int, pick: int) -> list[int]:
    """One 64-bit mask for each combination of ``pick`` blocks."""
    n = radius + pick
    edges = [round(64 * i / n) for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(blocks, pick)]


def block_keys(radius: int, pick: int) -> Column:
    signed = [m - (1 << 64) if m >> 63 else m for m in block_masks(radius, pick)]
    return F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("long")))
                     for i, m in enumerate(signed)])


def cells(items: DataFrame, keys: Column) -> DataFrame:
    """``items`` (fp long, more columns) -> rows of ``items`` with ``cell``.

    A row appears once per key of ``keys``, and once per chunk of its key
    where the key is hot. Key sizes are estimated from one fingerprint in
    SAMPLE (by hash); the estimate only sizes cells, every pair meets anyway.
    """
    keyed = items.withColumn("cell", F.explode(keys))
    few = items.where(F.pmod(F.xxhash64("fp", F.lit(3)), F.lit(SAMPLE)) == 0).select(F.explode(keys).alias("cell"))
    hot = materialize(few.groupBy("cell").count().where(F.col("count") * SAMPLE > CELL)
                      .select("cell", F.ceil(F.col("count") * SAMPLE / CELL).cast("int").alias("chunks")), "hot-keys")
    if hot.isEmpty():
        return keyed
    # the other columns of the row spread equal fingerprints too
    mine = F.pmod(F.xxhash64(*[F.col(c) for c in items.columns], F.lit(7)), F.col("chunks")).cast("int")
    return (keyed.join(hot, "cell", "left").withColumn("mine", mine)
            .withColumn("other", F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(-1)))
                                           .otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))))
            .withColumn("cell", F.when(F.col("chunks").isNull(), F.col("cell")).otherwise(
                F.xxhash64("cell", F.least("mine", "other"), F.greatest("mine", "other"))))
            .drop("chunks", "mine", "other"))


def bit_sliced(fps: np.ndarray, radius: int) -> np.ndarray:
    """Square boolean matrix of the pairs of ``fps`` (uint64) that differ in at
    most ``radius`` (< 8) bits.

    Bit ``b`` of 64 fingerprints lies in one word of plane ``b``. The bits in
    which a query differs are added into the vertical counters one, two and
    four with carries (``over`` holds what passes seven). After each eight
    planes a query whose whole row exceeds the radius is abandoned.
    """
    m = len(fps)
    bits = np.unpackbits(fps.astype(">u8").view(np.uint8).reshape(m, 8), axis=1)
    pad = np.zeros((-m % 64, 64), np.uint8)
    vertical = np.ascontiguousarray(np.concatenate([bits, pad]).T)
    planes = np.packbits(vertical, axis=1, bitorder="little").view("<u8")
    out = np.zeros((m, m), bool)
    step = max(1, (1 << 17) // planes.shape[1])
    for at in range(0, m, step):
        rows = np.arange(at, min(m, at + step))
        one = np.zeros((len(rows), planes.shape[1]), np.uint64)
        two, four, over = one.copy(), one.copy(), one.copy()
        for b in range(64):
            flip = (np.uint64(0) - bits[rows, b].astype(np.uint64))[:, None]
            x = planes[b][None, :] ^ flip
            carry = one & x
            one ^= x
            x = two & carry
            two ^= carry
            over |= four & x
            four ^= x
            if b % 8 == 7:
                live = ~(beyond(one, two, four, over, radius) == ALL).all(1)
                if not live.all():
                    rows, one, two, four, over = (v[live] for v in (rows, one, two, four, over))
                    if not len(rows):
                        break
        if len(rows):
            near = ~beyond(one, two, four, over, radius)
            out[rows] = np.unpackbits(near.astype("<u8").view(np.uint8).reshape(len(rows), -1), axis=1,
                                      bitorder="little")[:, :m].astype(bool)
    return out


def beyond(one, two, four, over, radius: int) -> np.ndarray:
    """Bits whose counter exceeds ``radius``: a bitwise comparison from the
    highest counter bit down."""
    more, same = over.copy(), ~over
    for plane, bit in ((four, radius >> 2 & 1), (two, radius >> 1 & 1), (one, radius & 1)):
        if bit:
            same = same & plane
        else:
            more = more | (same & plane)
            same = same & ~plane
    return more


def grouped(batches: Iterator[pa.RecordBatch], key: str, least: int = 2) -> Iterator[pa.Table]:
    """Runs of equal ``key`` of ``least`` (1 or 2) rows or more from a sorted
    stream of batches, also across batch ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        starts = np.concatenate([[0], cuts, [len(keys)]])
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        if len(starts) > 2:
            first = batch.slice(0, int(starts[1]))
            if held or first.num_rows >= least:
                yield pa.Table.from_batches([*held, first])
            for i in np.flatnonzero(np.diff(starts[1:-1]) >= least) + 1:
                yield pa.Table.from_batches([batch.slice(int(starts[i]), int(starts[i + 1] - starts[i]))])
            held = [batch.slice(int(starts[-2]))]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def in_cells(celled: DataFrame, work: Callable[[pa.Table], pa.Table | None], schema: str) -> DataFrame:
    """``work`` on the rows of each cell that holds more than one; the cells are
    bounded, and sorting brings them together without a Python group each."""
    def run(batches):
        for cell in grouped(batches, "cell"):
            if cell.num_rows > 1 and (done := work(cell)) is not None:
                yield from done.to_batches()
        release()

    return celled.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, schema)


def smallest_linked(rows: np.ndarray, cols: np.ndarray, m: int) -> np.ndarray:
    """For each of ``m`` items the smallest index in its connected group of the
    pairs (rows, cols)."""
    label = np.arange(m)
    while True:
        least = label.copy()
        np.minimum.at(least, rows, label[cols])
        np.minimum.at(least, cols, label[rows])
        least = least[least]
        if (least == label).all():
            return label
        label = least


def tree_links(fp: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> pa.Table | None:
    label = smallest_linked(rows, cols, len(fp))
    linked = np.flatnonzero(fp[label] != fp)
    if len(linked):
        pair = fp[linked], fp[label[linked]]
        return pa.table({"u": np.maximum(*pair), "v": np.minimum(*pair)})


def small_cells(cell: np.ndarray, fp: np.ndarray, radius: int, sizes: np.ndarray | None = None,
                apart: float = 0) -> pa.Table | None:
    """Links inside each run of equal ``cell`` (of SMALL rows at most), many runs at
    a time: each row against the next, the next but one, and so on."""
    rows, cols, at = [], [], np.arange(len(cell))
    for shift in range(1, SMALL):
        at = at[at + shift < len(cell)]
        at = at[cell[at] == cell[at + shift]]
        if not len(at):
            break
        near = at[np.bitwise_count(fp[at].view(np.uint64) ^ fp[at + shift].view(np.uint64)) <= radius]
        if sizes is not None:
            near = near[of_like_size(sizes[near], sizes[near + shift], apart)]
        rows.append(near)
        cols.append(near + shift)
    return tree_links(fp, np.concatenate(rows), np.concatenate(cols)) if rows else None


def of_like_size(a: np.ndarray, b: np.ndarray, apart: float) -> np.ndarray:
    return np.abs(a - b) <= apart * np.maximum(a, b) + 1e-9


def large_cell(fp: np.ndarray, radius: int, sizes: np.ndarray, apart: float) -> pa.Table | None:
    """Links inside one cell for any radius: SMALL rows against all later ones at a time."""
    bits, rows, cols = fp.view(np.uint64), [], []
    for at in range(0, len(fp), SMALL):
        some = slice(at, at + SMALL)
        close = np.bitwise_count(bits[some, None] ^ bits[None, at:]) <= radius
        close &= of_like_size(sizes[some, None], sizes[None, at:], apart)
        i, j = np.nonzero(np.triu(close, 1))
        rows.append(i + at)
        cols.append(j + at)
    return tree_links(fp, np.concatenate(rows), np.concatenate(cols))


def fingerprint_links(fps: DataFrame, radius: int, pick: int = 2, sliced: bool = True) -> DataFrame:
    """Distinct ``fps`` (fp long) -> links (u, v), u > v, a spanning forest of
    each cell's pairs within ``radius`` bits (never all pairs of a cell). Cells
    are compared bit-sliced; with ``sliced`` false only those above SMALL rows."""
    def work(cell: pa.Table):
        fp = np.unique(cell.column("fp").to_numpy())
        return tree_links(fp, *np.nonzero(bit_sliced(fp.view(np.uint64), radius)))

    celled = cells(fps, block_keys(radius, pick))
    if sliced:
        return in_cells(celled, work, "u long, v long")
    return links_in_cells(celled, lambda cell, fp, _: small_cells(cell, fp, radius),
                          lambda fp, _: work(pa.table({"fp": fp})))


def keyed_links(fps: DataFrame, keys: Column, radius: int, apart: float) -> DataFrame:
    """``fps`` (fp long, chars int, more columns) -> links (u, v) as above, of pairs that
    share one of ``keys`` and lie within ``radius`` bits, and whose ``chars`` differ
    by the share ``apart`` of the larger at most."""
    return links_in_cells(cells(fps, keys).select("cell", "fp", "chars"),
                          lambda cell, fp, sizes: small_cells(cell, fp, radius, sizes, apart),
                          lambda fp, sizes: large_cell(fp, radius, sizes, apart))


def links_in_cells(celled: DataFrame, small: Callable, large: Callable) -> DataFrame:
    """``small`` on many cells of up to SMALL rows at a time, ``large`` on each other one;
    both take fp and the column after it (or nothing)."""
    def run(batches):
        held = None
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = new if held is None else [np.concatenate(c) for c in zip(held, new)]
            if not len(held[0]):
                continue
            whole = int(np.searchsorted(held[0], held[0][-1]))  # the last run may go on
            yield from found(*[c[:whole] for c in held])
            held = [c[whole:] for c in held]
        if held is not None:
            yield from found(*held)
        held = None
        release()

    def found(cell, fp, sizes=None):
        if len(cell) > 1:
            starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            counts = np.diff(np.append(starts, len(cell)))
            few = np.repeat((counts > 1) & (counts <= SMALL), counts)
            links = [small(cell[few], fp[few], None if sizes is None else sizes[few])]
            for i in np.flatnonzero(counts > SMALL).tolist():
                run_of = slice(starts[i], starts[i] + counts[i])
                links.append(large(fp[run_of], None if sizes is None else sizes[run_of]))
            for t in links:
                yield from [] if t is None else t.to_batches()

    columns = [c for c in ("cell", "fp", "chars") if c in celled.columns]
    return (celled.select(*columns).repartition("cell").sortWithinPartitions("cell")
            .mapInArrow(run, "u long, v long"))


def components(links: DataFrame) -> DataFrame:
    """links (u, v) -> (node, root): root is the smallest node of the group.

    Large-star and small-star rounds: each is two partial minimum aggregates
    and two joins over the links, so a hub is neither collected nor held by one
    task. Rounds end when the links no longer change.
    """
    spark = links.sparkSession
    links = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .where("u <> v").distinct(), "links")
    state = mark(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        large = materialize(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        before, links = links, materialize(small, "small-star")
        discard(before, large)
        if (now := mark(links)) == state:
            break
        state = now
    roots = links.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def mark(links: DataFrame) -> tuple:
    """Count and order-free checksum of the links."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
