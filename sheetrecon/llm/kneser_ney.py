"""Modified Kneser-Ney model over byte n-grams, counted and computed by Spark.

The model is a set of tables: for each order the probability of every seen
n-gram, and for each context its back-off weight. ``log_probs`` looks up any
n-grams (seen or not) by joins; the values of the n-grams that a corpus holds
are then put into hash arrays of bounded size, one broadcast a shard.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytegrams
from .common import discard, materialize, release, text_bytes

ORDER = 5
#: Rows of a table that may be broadcast (a row per language).
GROUPS = 100_000


def counted_grams(docs: DataFrame, group_col: str, text_col: str, order: int = ORDER) -> DataFrame:
    """(grp, gram, n): n-grams of all words of all texts by group."""
    def run(batches):
        counter = bytegrams.GramCounter(order)
        for batch in batches:
            groups, at = batch.column(0).to_pylist(), 0
            for texts in text_bytes(batch.column(1)):
                by: dict = {}
                for group, text in zip(groups[at:at + len(texts)], texts):
                    if part := bytegrams.framed(text, order):
                        by.setdefault(group, []).append(part)
                for group, parts in by.items():
                    counter.add(group, parts)
                at += len(texts)
        yield from counter.batches(pa.string())
        del counter
        release()

    found = (docs.select(F.col(group_col).cast("string").alias("grp"), F.col(text_col).alias("text"))
             .mapInArrow(run, "grp string, gram long, n long"))
    return found.groupBy("grp", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    order: int
    probs: list[DataFrame]  # probs[k]: grp, gram of k + 1 bytes, p
    backoff: list[DataFrame]  # backoff[k]: grp, ctx of k bytes, w


def low_bytes(column: str, n: int) -> Column:
    return F.col(column).bitwiseAND(F.lit((1 << 8 * n) - 1))


def same_group() -> Column:
    return F.col("a.grp").eqNullSafe(F.col("b.grp"))


def train(grams: DataFrame, order: int = ORDER) -> Model:
    """Model of counted n-grams. The top order uses counts, lower ones the
    number of distinct bytes that precede an n-gram; three discounts for each
    order and group come from the counts of counts (0.5, 1, 1.5 where those
    leave them undefined); the unigrams are mixed with 1/256."""
    levels = [materialize(grams.select("grp", "gram", F.col("n").alias("c")), "grams")]
    for k in range(order - 1, 0, -1):
        levels.append(levels[-1].groupBy("grp", low_bytes("gram", k).alias("gram"))
                      .agg(F.count("*").alias("c")))
    probs, backoff = [], []
    for k, level in enumerate(reversed(levels)):
        level = materialize(level, f"grams{k + 1}")
        cut = discounts(level)
        named = joined(level, cut, []).withColumn("ctx", F.shiftright("gram", 8))
        cost = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        named = named.withColumn("cut", cost)
        weights = (named.groupBy("grp", "ctx").agg(F.sum("c").alias("total"), F.sum("cut").alias("mass"))
                   .select("grp", "ctx", "total", (F.col("mass") / F.col("total")).alias("w")))
        backoff.append(materialize(weights, f"weights{k}"))
        lower = F.lit(1 / 256)
        rows = joined(named, backoff[-1], ["ctx"])
        if probs:
            rows = joined(rows.withColumn("sub", low_bytes("gram", k)),
                          probs[-1].select("grp", F.col("gram").alias("sub"), F.col("p").alias("q")), ["sub"])
            lower = F.col("q")
        p = (F.col("c") - F.col("cut")) / F.col("total") + F.col("w") * lower
        probs.append(materialize(rows.select("grp", "gram", p.alias("p")), f"probs{k + 1}"))
    return Model(order, probs, backoff)


def joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on group (nulls are equal) and ``on``; keeps the left group."""
    a, b = left.alias("a"), right.alias("b")
    test = same_group()
    for c in on:
        test = test & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    return a.join(b, test, how).select("a.*", *[f"b.{c}" for c in right.columns if c not in ("grp", *on)])


def discounts(level: DataFrame) -> DataFrame:
    n = [F.sum(F.when(F.col("c") == i, 1).otherwise(0)).alias(f"n{i}") for i in range(1, 5)]
    y = F.expr("n1 / nullif(n1 + 2 * n2, 0)")

    def one(i: int, default: float) -> Column:
        found = F.lit(i) - (i + 1) * y * F.col(f"n{i + 1}") / F.expr(f"nullif(n{i}, 0)")
        return F.when(found.between(0, i), found).otherwise(F.lit(default)).alias(f"d{i}")

    return bounded(level.groupBy("grp").agg(*n).select("grp", one(1, 0.5), one(2, 1.0), one(3, 1.5)))


def bounded(rows: DataFrame) -> DataFrame:
    """A table of a row per group, broadcast only when it is counted to be small."""
    rows = materialize(rows, "per-group")
    return F.broadcast(rows) if rows.count() <= GROUPS else rows


def log_probs(grams: DataFrame, model: Model) -> DataFrame:
    """grams (grp, gram) -> with lp: log10 probability of the last byte after
    the others, backed off to lower orders where the model has not seen it."""
    rows = grams.select("grp", "gram")
    p = F.lit(1 / 256)
    for k in range(model.order):
        rows = (rows.withColumn("sub", low_bytes("gram", k + 1)).withColumn("ctx", F.shiftright("sub", 8)))
        rows = joined(rows, model.probs[k].select("grp", F.col("gram").alias("sub"), F.col("p").alias(f"p{k}")),
                      ["sub"], "left")
        rows = joined(rows, model.backoff[k].select("grp", "ctx", F.col("w").alias(f"w{k}")), ["ctx"], "left")
        p = F.coalesce(f"p{k}", F.coalesce(f"w{k}", F.lit(1.0)) * p)
        rows = rows.drop("sub", "ctx")
    return rows.select("grp", "gram", F.log10(p).alias("lp"))


def hash_arrays(values: DataFrame, order: int):
    """(grp, gram, lp) -> broadcast hash arrays of about ENTRIES entries each,
    made one after the other; every n-gram lies in exactly one."""
    values = materialize(values.select("grp", "gram", "lp"), "values")
    shards = max(1, -(-values.count() // bytegrams.ENTRIES))
    for i in range(shards):
        rows = values.where(F.pmod(F.xxhash64("grp", "gram"), F.lit(shards)) == i).toArrow()
        names = rows.column("grp").combine_chunks().dictionary_encode("encode")
        hashes = np.array([bytegrams.group_hash(g) for g in names.dictionary.to_pylist()], np.uint64)
        groups = hashes[names.indices.to_numpy()] if len(rows) else np.zeros(0, np.uint64)
        keys = bytegrams.keyed(rows.column("gram").to_numpy(), groups, order)
        yield values.sparkSession.sparkContext.broadcast(
            bytegrams.HashArray(keys, rows.column("lp").to_numpy().astype(np.float32)))


def score_udf(array, order: int, lower: bool):
    """Column function (group, text) -> sum of the values of the text's n-grams
    that lie in one hash array; with ``lower`` A-Z count as a-z, and a text without
    words is its end."""
    @F.arrow_udf("double")
    def run(group: pa.Array, text: pa.Array) -> pa.Array:
        groups, found, at = [bytegrams.group_hash(g) for g in group.to_pylist()], [], 0
        for texts in text_bytes(text):
            parts = [bytegrams.framed(t.lower() if lower else t, order, lower) for t in texts]
            codes, counts = bytegrams.gram_codes(parts, order)
            names = np.repeat(np.array(groups[at:at + len(texts)], np.uint64), counts)
            lp = array.value.get(bytegrams.keyed(codes, names, order), 0.0)
            found.append(bytegrams.doc_sums(lp, counts))
            at += len(texts)
        release()
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return run


def with_scores(rows: DataFrame, values: DataFrame, group: Column, text: Column, order: int = ORDER,
                lower: bool = False) -> DataFrame:
    """``rows`` with lp, the log10 probability of each text: a pass for each hash
    array, so that a task holds one at a time whatever the size of the model."""
    rows, last, held = rows.withColumn("lp", F.lit(0.0)), None, []
    for array in hash_arrays(values, order):
        if last is not None:
            rows = materialize(rows, "scored")
            discard(*held)
            last.unpersist()
            held = [rows]
        rows, last = rows.withColumn("lp", F.col("lp") + score_udf(array, order, lower)(group, text)), array
    return rows
