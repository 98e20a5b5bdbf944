"""Importance resampling towards a target distribution (operator 11).

Runs of one to three words of both sides fall into hash buckets; the log ratio of
the bucket counts is an array of gains, and a document's weight the sum of the
gains of its features. With a fixed Gumbel-like noise per document the highest
scores are a weighted draw without replacement. They are ranked by a distributed
radix sort from the least significant digit: each pass counts the digits of every
part, turns the counts into global offsets, and moves each row to its place; equal
digits keep their order.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batched, materialize, release, text_bytes
from .near import grouped
from .suffixes import item_words

BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
#: Bits of a digit of the radix sort: 2 ** DIGIT offsets at most reach the driver.
DIGIT = 12
#: Rows of a part at most, and at least where there are fewer rows.
PART_MOST, PART_LEAST = 1 << 18, 1 << 8
#: Words of up to so many bytes share the table of shifts.
SHORT = 64


def zero_step() -> np.ndarray:
    """(4, 256): effect of one zero byte on each byte of a CRC register."""
    table = np.zeros(256, np.uint32)
    for i in range(256):
        c = i
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table[i] = c
    values = np.arange(256, dtype=np.uint32)
    return np.stack([table, *(values << np.uint32(8 * k - 8) for k in (1, 2, 3))])


def after(step: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """``crc`` after the zero bytes that the table ``step`` stands for."""
    return (step[0][crc & 255] ^ step[1][crc >> 8 & 255] ^ step[2][crc >> 16 & 255] ^ step[3][crc >> 24])


class Joined:
    """CRC-32 of joined texts from those of the parts."""

    def __init__(self):
        one, same = zero_step(), np.arange(256, dtype=np.uint32)
        steps = [np.stack([same << np.uint32(8 * k) for k in range(4)])]
        for _ in range(SHORT):
            steps.append(after(one, steps[-1]))
        self.steps = np.stack(steps)
        self.space = np.uint32(zlib.crc32(b" "))

    def shifted(self, crc: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Each ``crc`` after its number of zero bytes."""
        out, left = crc.copy(), sizes.copy()
        step, first = self.steps, np.minimum(left, SHORT)
        out = (step[first, 0, out & 255] ^ step[first, 1, out >> 8 & 255]
               ^ step[first, 2, out >> 16 & 255] ^ step[first, 3, out >> 24])
        left = left - first
        doubled = step[SHORT]
        left, rest = left // SHORT, left % SHORT
        out = (step[rest, 0, out & 255] ^ step[rest, 1, out >> 8 & 255]
               ^ step[rest, 2, out >> 16 & 255] ^ step[rest, 3, out >> 24])
        while left.any():  # words of over SHORT bytes are few
            out = np.where(left & 1, after(doubled, out), out)
            left, doubled = left >> 1, after(doubled, doubled)
        return out

    def __call__(self, words: list[bytes], longest: int = LONGEST) -> list[np.ndarray]:
        """CRC-32 of all runs of 1, 2, ... ``longest`` words joined by one blank; run
        ``i`` of each length starts at word ``i``."""
        alone = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        spaced = self.shifted(np.full(len(words), self.space), sizes) ^ alone
        runs = [alone]
        for k in range(1, longest):
            n = max(0, len(words) - k)
            runs.append(self.shifted(runs[-1][:n], sizes[len(words) - n:] + 1) ^ spaced[len(words) - n:])
        return runs


def features(texts: list[bytes], joined: Joined, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of all features of the texts, the text of each, words of each text)."""
    split = [item_words(t) for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    owner = np.repeat(np.arange(len(split)), counts)
    found, of = [], []
    for k, run in enumerate(joined([w for words in split for w in words])):
        inside = owner[:len(run)] == owner[k:k + len(run)]
        found.append((run[inside] % np.uint32(buckets)).astype(np.int64))
        of.append(owner[:len(run)][inside])
    return np.concatenate(found), np.concatenate(of), counts


def bucket_counts(docs: DataFrame, text_col: str, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket (``buckets`` numbers)."""
    def run(batches):
        joined, total = Joined(), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in text_bytes(batch.column(0)):
                total += np.bincount(features(part, joined, buckets)[0], minlength=buckets)
        release()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": at, "n": total[at]})

    rows = (batched(docs).select(F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of the smoothed shares of each bucket."""
    n, all_raw, all_target = len(raw), int(raw.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float((t + 1) * (all_raw + n)) / float((s + 1) * (all_target + n))))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """Row per document: doc_id, n_words, n_features, weight (the sum of the gains of
    its features)."""
    sent, buckets = docs.sparkSession.sparkContext.broadcast(gain), len(gain)

    @F.arrow_udf("struct<n_words long, n_features long, weight long>")
    def run(text: pa.Array) -> pa.Array:
        joined, gain = Joined(), sent.value
        rows = []
        for part in text_bytes(text):
            bucket, of, counts = features(part, joined, buckets)
            total = np.zeros(len(part), np.int64)
            np.add.at(total, of, gain[bucket])
            rows.append((counts, np.bincount(of, minlength=len(part)), total))
        release()
        columns = [np.concatenate([r[k] for r in rows]) if rows else np.zeros(0, np.int64) for k in range(3)]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                          ["n_words", "n_features", "weight"])

    return (batched(docs).select(F.col(f"`{id_col}`").alias("doc_id"), run(F.col(f"`{text_col}`")).alias("found"))
            .select("doc_id", "found.*"))


def noise(doc_id, seed: int):
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256(seed:doc_id)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    u = (F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(u))).cast("long")


class Digits:
    """The digits of a composite key, least significant first. ``columns`` are (name,
    least, most, descending) with the most significant first; nulls come last. A column
    takes as many bits as its range needs, and one value more for null."""

    def __init__(self, columns: list[tuple[str, int, int, bool]], width: int = DIGIT):
        self.columns, self.width, self.bits = columns, width, []
        for _, least, most, _ in reversed(columns):
            self.bits.append((most - least + 1).bit_length())
        self.passes = max(1, -(-sum(self.bits) // width))

    def __call__(self, batch: pa.RecordBatch, number: int) -> np.ndarray:
        """Digit ``number`` of every row."""
        out, low = np.zeros(batch.num_rows, np.int64), 0
        first, last = number * self.width, (number + 1) * self.width
        for (name, least, most, descending), bits in zip(reversed(self.columns), self.bits):
            if low < last and low + bits > first:
                column = batch.column(name)
                value = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                value = np.uint64(most % 2 ** 64) - value if descending else value - np.uint64(least % 2 ** 64)
                nulls = column.is_null().to_numpy(zero_copy_only=False)
                shift = first - low
                if shift >= 0:
                    part = value >> np.uint64(shift) if shift < 64 else np.zeros_like(value)
                    null = (most - least + 1) >> shift
                    out |= np.where(nulls, null & (1 << self.width) - 1,
                                    (part & np.uint64((1 << self.width) - 1)).astype(np.int64))
                else:
                    room = (1 << self.width + shift) - 1
                    out |= np.where(nulls, (most - least + 1) & room,
                                    (value & np.uint64(room)).astype(np.int64)) << -shift
            low += bits
        return out


def digit_udf(digits: Digits, number: int, columns: list[str]):
    @F.arrow_udf("int")
    def run(*found: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays(list(found), columns)
        return pa.array(digits(batch, number).astype(np.int32))

    return run(*columns)


def radix_sorted(rows: DataFrame, columns: list[tuple[str, bool]], width: int = DIGIT) -> DataFrame:
    """``rows`` (narrow, all long) with ``place`` (from 0) in the order of ``columns``, each
    (name, descending), nulls last.

    One pass per digit of the composite key. Rows lie at positions; a part is a range of
    them, of PART_MOST at most. (1) count rows by part and digit; (2) a digit's start is
    the number of rows of smaller digits (one number per digit value), a part's start in
    it the rows of the digit in earlier parts (a running sum over the parts); (3) each
    part sorts its rows by digit, stably, and sends each to its position, the start plus
    its rank. Every pass is written, so a lost executor costs its tasks only.
    """
    names = rows.columns
    rows = materialize(rows.withColumn("place", F.monotonically_increasing_id()), "unsorted")
    range_of = rows.agg(F.count("*"), *[f(c) for c, _ in columns for f in (F.min, F.max)]).first()
    n = range_of[0]
    digits = Digits([(c, range_of[2 * k + 1] or 0, range_of[2 * k + 2] or 0, down)
                     for k, (c, down) in enumerate(columns)], width)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = min(PART_MOST, max(PART_LEAST, -(-n // (4 * parts))))
    part = F.expr(f"place div {size}")
    keys = [c for c, _ in columns]
    rows = rows.withColumn("digit", digit_udf(digits, 0, keys))
    for number in range(digits.passes):
        rows = materialize(moved(rows.withColumn("part", part), names, digits, number), "pass")
    return rows.drop("digit")


def moved(rows: DataFrame, names: list[str], digits: Digits, number: int) -> DataFrame:
    """One pass: rows (names, place, digit, part) -> rows at their new places with the
    next digit."""
    counts = materialize(rows.groupBy("part", "digit").agg(F.count("*").alias("n")), "digit-counts")
    found = counts.groupBy("digit").agg(F.sum("n").alias("n")).toArrow()  # 2 ** width rows at most
    totals = np.zeros(1 << digits.width, np.int64)
    totals[found["digit"].to_numpy()] = found["n"].to_numpy()
    start = np.cumsum(totals) - totals
    earlier = Window.partitionBy("digit").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "digit", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("place"))
    # a part's offsets travel with its rows, before them
    both = rows.select(*names, "part", "digit", "place", F.lit(1).alias("kind")).unionByName(
        offsets.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    last = number + 1 == digits.passes

    def run(batches):
        for table in grouped(batches, "part"):
            kind = table.column("kind").to_numpy()
            heads = table.slice(0, int((kind == 0).sum()))
            body = table.slice(heads.num_rows).combine_chunks()
            base = start.copy()
            base[heads.column("digit").to_numpy()] += heads.column("place").to_numpy()
            digit = body.column("digit").to_numpy()
            order = np.argsort(digit, kind="stable")
            here = digit[order]
            rank = np.arange(len(here)) - np.searchsorted(here, here)
            place = np.empty(len(here), np.int64)
            place[order] = base[here] + rank
            out = pa.RecordBatch.from_arrays([body.column(c).combine_chunks() if body.num_rows else
                                              pa.array([], pa.int64()) for c in names], names)
            following = np.zeros(len(here), np.int64) if last else digits(out, number + 1)
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(place), pa.array(following, pa.int32())],
                                             [*names, "place", "digit"])
        release()

    schema = ", ".join(f"{c} long" for c in names) + ", place long, digit int"
    return both.repartition("part").sortWithinPartitions("part", "kind", "place").mapInArrow(run, schema)


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
              seed: int = SEED) -> DataFrame:
    """Row per row of ``docs``: doc_id, n_features, weight, score and rank (null where the
    row is not drawn: beyond ``percent`` of the rows of ``least_words`` words or more, or
    shorter than that).

    Null and empty texts have no features and weight 0. Ties of the score go to the
    smaller id, null ids last (their noise is that of an empty id); rows of one id and
    score are ordered by their number of features, and equal rows get a rank each. Empty
    tables give an empty result; without target texts all gains follow from the
    smoothing. Other columns are ignored.
    """
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, text_col, buckets))
    rows = weighted(docs, gain, id_col, text_col)
    rows = materialize(rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "weights")
    long_enough = F.col("n_words") >= least_words
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = radix_sorted(rows.where(long_enough).select(*columns),
                          [("score", True), ("doc_id", False), ("n_features", False)])
    drawn = percent * ranked.count() // 100
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    return ranked.select(*columns, rank.alias("rank")).unionByName(
        rows.where(~long_enough).select(*columns, F.lit(None).cast("long").alias("rank")))
