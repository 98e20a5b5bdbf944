"""Language-model scoring by partial matching over bytes (operator 5).

The trie is a set of tables: a node is a context of up to ORDER - 1 bytes, with
the counts of the bytes that follow it in the training texts; shorter contexts
count in how many longer ones a byte was seen (update exclusion). A byte's
probability comes from the longest context seen; where the byte was not seen
after it, the model escapes to the next shorter one, in which all bytes that the
longer one knows are excluded. Each distinct byte lends half a count to the
escape (method D). Spark computes this once for every distinct n-gram of the
corpus; a text's code length is the sum over its bytes.

The base score needs the training count of every word. Texts are dealt out in
blocks; each block asks for its distinct words only, so a frequent word costs
one row a block, and no task holds the vocabulary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import bytegrams, kneser_ney
from .common import batched, materialize, text_bytes, words

#: Bytes of an n-gram: contexts of up to five bytes.
ORDER = 6
#: Blocks of texts for each shuffle partition.
BLOCKS = 1
ALPHA = 0.1


def corpus_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """docs (text, train) -> gram, c: every n-gram of the corpus, lower-cased, with
    its count in the training texts."""
    def run(batches):
        counter = bytegrams.GramCounter(order)
        for batch in batches:
            train, at = batch.column(1).to_pylist(), 0
            for texts in text_bytes(batch.column(0)):
                by: dict[bool, list[bytes]] = {True: [], False: []}
                for t, known in zip(texts, train[at:at + len(texts)]):
                    by[known].append(bytegrams.framed(t.lower(), order, True))
                for known, parts in by.items():
                    counter.add(known, parts)
                at += len(texts)
        yield from counter.batches(pa.bool_())

    found = docs.select("text", "train").mapInArrow(run, "grp boolean, gram long, n long")
    return found.groupBy("gram").agg(F.sum(F.when(F.col("grp"), F.col("n")).otherwise(0)).alias("c"))


def low(column: str, k: int) -> Column:
    return kneser_ney.low_bytes(column, k)


def code_lengths(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, c -> gram, lp: log10 probability of the last byte after the others.

    nodes[k] has the n-grams of k + 1 bytes (count c), contexts[k] the contexts of
    k bytes: n (count), t (distinct bytes) and m (count that the next shorter
    context gives to those bytes, which an escape to it excludes).
    """
    grams = materialize(grams, "grams")
    nodes: list[DataFrame] = [None] * order
    contexts = []
    nodes[-1] = grams.where("c > 0").select(F.col("gram").alias("sub"), "c")
    for k in reversed(range(order - 1)):
        shorter = nodes[k + 1].groupBy(low("sub", k + 1).alias("sub")).agg(F.count("*").alias("c"))
        nodes[k] = materialize(shorter, f"nodes{k}")
    for k in range(order):
        inner = nodes[k].withColumn("ctx", F.shiftright("sub", 8))
        if k:
            shorter = small(nodes[k - 1].select(F.col("sub").alias("tail"), F.col("c").alias("s")), k - 1)
            inner = inner.withColumn("tail", low("sub", k)).join(shorter, "tail")
        else:
            inner = inner.withColumn("s", F.lit(0))
        stats = inner.groupBy("ctx").agg(F.sum("c").alias("n"), F.count("*").alias("t"), F.sum("s").alias("m"))
        contexts.append(materialize(stats, f"contexts{k}"))
    rows = grams.select("gram")
    for k in reversed(range(order)):
        rows = rows.withColumn("sub", low("gram", k + 1)).withColumn("ctx", F.shiftright("sub", 8))
        rows = rows.join(small(nodes[k].withColumnRenamed("c", f"c{k}"), k), "sub", "left")
        stats = contexts[k].select("ctx", *[F.col(c).alias(f"{c}{k}") for c in "ntm"])
        rows = rows.join(small(stats, k - 1), "ctx", "left").drop("sub", "ctx")
    # bytes that the empty context has not seen are alike
    lp = F.when(F.coalesce(*[F.col(f"c{k}") for k in range(order)]).isNull(),
                -F.log10(256 - F.coalesce("t0", F.lit(0)))).otherwise(0.0)
    for k in range(order):
        longer = [F.col(f"c{j}") for j in range(k + 1, order)]
        reached = F.coalesce(*longer).isNull() if longer else F.lit(True)
        out_n, out_t = (F.coalesce(f"{c}{k + 1}", F.lit(0)) if longer else F.lit(0) for c in "mt")
        t = F.col(f"t{k}") - out_t
        taken = F.coalesce(2 * F.col(f"c{k}") - 1, t)  # the byte, or else the escape
        lp = lp + F.when(reached & (t > 0), F.log10(taken / (2 * (F.col(f"n{k}") - out_n)))).otherwise(0.0)
    return rows.select(F.lit(None).cast("string").alias("grp"), "gram", lp.alias("lp"))


def small(table: DataFrame, k: int) -> DataFrame:
    """Tables of n-grams of up to two bytes have 65,536 rows at most: broadcast."""
    return F.broadcast(table) if k <= 1 else table


def block_words(batches):
    """(block, text, train, ...) -> block, word, n: the distinct words of each block
    with their training count; the empty word is the end of a text."""
    found: dict[int, dict[bytes, int]] = {}
    for batch in batches:
        blocks, train, at = batch.column("block").to_pylist(), batch.column("train").to_pylist(), 0
        for texts in text_bytes(batch.column("text")):
            for t in texts:
                counts = found.setdefault(blocks[at], {})
                if train[at]:
                    for w in [*words(t.lower()), b""]:
                        counts[w] = counts.get(w, 0) + 1
                else:
                    for w in [*words(t.lower()), b""]:
                        counts.setdefault(w, 0)
                at += 1
    for block, counts in found.items():
        names, n = list(counts), list(counts.values())
        for i in range(0, len(names), 1 << 16):
            part = names[i:i + (1 << 16)]
            yield pa.record_batch({"block": pa.array([block] * len(part), pa.int32()),
                                   "word": pa.array(part, pa.binary()), "n": pa.array(n[i:i + (1 << 16)], pa.int64())})


def block_scores(docs: pa.Table, vocabulary: pa.Table) -> pa.Table:
    """Texts of a block with the corpus counts of its words -> a row per text, and one
    (kind 1) with the block's share of N and V."""
    names = vocabulary.column("word").to_pylist()
    count = vocabulary.column("c").to_numpy()
    value = dict(zip(names, np.log10(count + ALPHA).tolist()))
    unseen = {w for w, c in zip(names, count.tolist()) if not c}
    base, tokens, known = [], [], []
    for texts in text_bytes(docs.column("text")):
        for t in texts:
            w = words(t.lower())
            w.append(b"")
            base.append(sum(map(value.__getitem__, w)))
            tokens.append(len(w))
            known.append(len(w) - sum(x in unseen for x in w) if unseen else len(w))
    size = len(docs)
    mine = np.asarray(vocabulary.column("owned").to_numpy(zero_copy_only=False), bool)
    share = pa.table({"kind": [1], "doc_id": pa.nulls(1, docs.column("doc_id").type), "held_out": pa.nulls(1, pa.bool_()),
                      "n_tokens": pa.array([int(mine.sum())]),
                      "n_known": pa.array([int(vocabulary.column("n").to_numpy().sum())]),
                      "base": pa.nulls(1, pa.float64()), "score": pa.nulls(1, pa.float64())})
    rows = pa.table({"kind": pa.array([0] * size, pa.int64()), "doc_id": docs.column("doc_id"),
                     "held_out": pa.compute.invert(docs.column("train")), "n_tokens": pa.array(tokens, pa.int64()),
                     "n_known": pa.array(known, pa.int64()), "base": pa.array(base, pa.float64()),
                     "score": docs.column("lp")})
    return pa.concat_tables([rows, share.cast(rows.schema)])


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10 probability that the byte model gives the lower-cased words, a blank
    between two, and the end).

    Texts whose crc32 of the id as text leaves remainder 0 by 10 are held out, all
    others (null ids too) train. A null or empty text is one token, the end, for both
    models. An empty table gives an empty result; other columns are ignored. Repeated rows each count. Without training texts all counts are 0.
    """
    rows = batched(docs).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 != 0, F.lit(True))
                       .alias("train"))
    values = code_lengths(corpus_grams(rows))
    rows = kneser_ney.with_scores(rows, values, F.lit(None).cast("string"), F.col("text"), ORDER, lower=True)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(BLOCKS * n)).cast("int")
    dealt = rows.withColumn("block", block).repartition(n, "block")
    # all columns, so that both uses share one exchange
    found = dealt.mapInArrow(block_words, "block int, word binary, n long")
    same = Window.partitionBy("word")
    first = F.min(F.when(F.col("n") > 0, F.col("block"))).over(same)
    asked = found.select("block", "word", "n", F.sum("n").over(same).alias("c"),
                         F.coalesce(first == F.col("block"), F.lit(False)).alias("owned"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = materialize(dealt.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(
        block_scores, f"kind long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, "
                      "base double, score double"), "scores")
    v, total = out.where("kind = 1").agg(F.coalesce(F.sum("n_tokens"), F.lit(0)),
                                         F.coalesce(F.sum("n_known"), F.lit(0))).first()
    scale = F.log10(F.lit(total + ALPHA * (v + 1)))
    return out.where("kind = 0").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * scale).alias("base_score"), "score")
