"""SimHash near-duplicate groups (operator 3).

Fingerprints of word shingles are computed in Arrow batches; distinct
fingerprints meet in pigeonhole cells, where bit-sliced comparison with
carry-save counters finds those within the radius; connected groups follow
from star rounds. Documents are joined with groups by fingerprint only.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import near
from .common import Bits, batched, materialize, release, text_bytes, words

SHINGLE, RADIUS, SEED = 3, 2, 42


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash: a bit is set if it is set in more than half of
    the XXH64 of the shingles, repeats included. No word: zero; fewer words
    than a shingle: the whole sequence is the one shingle."""
    tokens = words(text.lower())
    if not tokens:
        return 0
    line = b" ".join(tokens)
    if len(tokens) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = list(accumulate(map(len, tokens), lambda at, n: at + 1 + n))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], SEED) for a, b in
                       zip([0, *[e + 1 for e in ends]], ends[shingle - 1:])])
    count = bit_counts(np.frombuffer(hashes, np.uint8).reshape(-1, 8))
    return int.from_bytes(np.packbits(2 * count > len(hashes) // 8).tobytes(), "big")


def bit_counts(digests: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set in big-endian digests (n, 8)."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(digests), 1 << 16):
        total += np.unpackbits(digests[at:at + (1 << 16)], axis=1).sum(0, dtype=np.uint32)
    return total


def fingerprint_udf(shingle: int):
    @F.arrow_udf("long")
    def run(text: pa.Array) -> pa.Array:
        found = [fingerprint(t, shingle) for part in text_bytes(text) for t in part]
        release()
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return run


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Row per row of ``docs``: doc_id, fingerprint (16 hex digits),
    component_id (smallest id reachable over links of at most ``radius`` bits).

    A null text has no words (fingerprint zero). Rows with the same text share
    a fingerprint and hence a group. Null ids never name a group; a group of
    null ids only has a null component_id. Other columns are ignored. An empty
    table gives an empty result.
    """
    rows = batched(docs).select(F.col(id_col).alias("doc_id"), fingerprint_udf(shingle)(F.col(text_col)).alias("fp"))
    rows = materialize(rows, "fingerprints")
    named = component_of(rows, radius)
    return (rows.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def component_of(rows: DataFrame, radius: int) -> DataFrame:
    """rows (doc_id, fp) -> one row per distinct fp: fp, root (fingerprint that
    names the group), component_id."""
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = near.components(near.fingerprint_links(distinct.select("fp"), radius))
    grouped = (distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
               .withColumn("root", F.coalesce("root", "fp")))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    return grouped.join(least, "root").select("fp", "root", "component_id")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group: the smallest id (null ids last; of
    repeated ids the least text hash; of rows that repeat both, one). All columns stay as
    they are. Null and empty texts form one group; an empty table stays empty.

    Fingerprints are taken once, into a table without the texts; there the row of each
    group is chosen. Only rows that a bounded bit table marks (others of a group, and
    repeated rows) are joined with the choice; the rest of ``docs`` is not moved.
    """
    text = F.col(f"`{text_col}`")
    name = [F.xxhash64(F.col(f"`{id_col}`"), text).alias("key"), F.xxhash64(F.lit(1), text).alias("other")]
    rows = materialize(batched(docs).select(F.col(f"`{id_col}`").alias("doc_id"), *name,
                                            fingerprint_udf(shingle)(text).alias("fp")), "fingerprints")
    named = component_of(rows, radius).select("fp", "root")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "other", "key")
    distinct = materialize(rows.groupBy("key", "other", "doc_id", "fp").agg(F.count("*").alias("n"))
                           .join(named, "fp").withColumn("order", order), "named-rows")
    best = distinct.groupBy("root").agg(F.min("order").alias("best"))
    marked = distinct.join(best, "root").withColumn("stays", F.col("order") == F.col("best"))
    marked = materialize(marked.where("n > 1 or not stays").select("key", "other", "stays"), "marked-rows")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(*name, row).withColumn("some", Bits(marked, "key").column("key"))
    # a marked row that stays is kept once, a marked row that goes not at all, and a row
    # that the bit table marks by chance as often as it is there
    some = keyed.where("some").join(marked, ["key", "other"], "left").select("key", "other", "row", "stays")
    return (keyed.where("not some").select("row.*")
            .unionByName(some.where("stays is null").select("row.*"))
            .unionByName(some.where("stays").dropDuplicates(["key", "other"]).select("row.*")))
