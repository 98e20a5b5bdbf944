"""Substring deduplication by super-k-mers (operator 10).

A window is WINDOW consecutive words. Its minimiser is the least MINIMISER-word
sequence in it, in a random order that puts very frequent sequences last.
Consecutive windows of a text that share their minimiser are one super-k-mer
and travel as one packed string to the minimiser's bucket, where the windows
are sorted: all but the first occurrence (smallest document, then start) of a
word sequence are repeats, and the words that they cover go.

Before anything is shuffled, a task keeps the first of equal super-k-mers of
its chunk; later ones are repeats as a whole. So a passage that many documents
share reaches its bucket once a chunk. Words around such a passage do not gather in
its bucket either, as frequent sequences are minimisers only of windows that
hold nothing else; how frequent they are is counted over all texts, in a table
of 2 ** SLOT_BITS counters.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Bits, WordHash, batched, doc_key, materialize, text_bytes, words
from .near import grouped

WINDOW, MINIMISER = 20, 3
#: Counters of three-word sequences; a slot with FREQUENT times the mean is frequent.
SLOT_BITS, FREQUENT = 17, 4
#: Text bytes of the chunk within which a task drops equal super-k-mers.
CHUNK_BYTES = 8 << 20
#: Buckets for each shuffle partition (evens out their sizes).
BUCKETS = 4
NULL_ID = np.iinfo(np.int64).min
ODD = np.random.default_rng(20).integers(1, 1 << 62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sequences(values: np.ndarray, length: int, odd: np.ndarray) -> np.ndarray:
    """A mixed 64-bit value of each run of ``length`` words."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = values[:n] * odd[0]
    for i in range(1, length):
        total += values[i:i + n] * odd[i]
    total ^= total >> np.uint64(31)
    return total * odd[length]


def windows_hash(values: np.ndarray, length: int, odd: int) -> np.ndarray:
    """Polynomial hash of each run of ``length`` words, by doubling."""
    have, out, at = values, None, 0
    size, base = 1, odd
    while True:
        if length & size:
            part = have[at:]
            if out is None:
                out = part
            else:
                n = min(len(out), len(part))
                out = out[:n] * np.uint64(base) + part[:n]
            at += size
        if size * 2 > length:
            break
        n = len(have) - size
        have = have[:max(n, 0)] * np.uint64(base) + have[size:] if n > 0 else have[:0]
        base = base * base & 0xFFFFFFFFFFFFFFFF
        size *= 2
    return out[:max(len(values) - length + 1, 0)]


def slot_counts(docs: DataFrame) -> np.ndarray:
    """How many three-word sequences of all texts fall into each slot."""
    def run(batches):
        hashes, count = WordHash(), np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for texts in text_bytes(batch.column(0)):
                # sequences across two texts count too: a few more of any slot
                mixed = sequences(hashes(b" ".join(words(b"\n".join(texts)))), MINIMISER, ODD)
                count += np.bincount((mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(count))
        used = np.flatnonzero(count)
        yield pa.record_batch({"slot": pa.array(used.astype(np.int32)), "n": pa.array(count[used])})

    counted = docs.select("text").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()  # a row per slot at most
    total = np.zeros(1 << SLOT_BITS, np.int64)
    total[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return total


def minimisers(values: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Least sequence of each window, frequent ones after all others."""
    mixed = sequences(values, MINIMISER, ODD)
    late = frequent[(mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
    order = (mixed * ODD[9] >> np.uint64(1)) | (late.astype(np.uint64) << np.uint64(63))
    span, size, least, at = WINDOW - MINIMISER + 1, 1, None, 0
    while size <= span:
        if span & size:
            part = order[at:]
            least = part if least is None else np.minimum(least[:len(part)], part[:len(least)])
            at += size
        order = np.minimum(order[:-size], order[size:]) if len(order) > size else order[:0]
        size *= 2
    return least[:max(len(values) - WINDOW + 1, 0)]


def packed(ids: np.ndarray, keys: np.ndarray, texts: list[bytes], frequent: np.ndarray, buckets: int,
           hashes: WordHash):
    """One chunk of documents -> (rows for the buckets, repeats found already).

    Documents are taken in ascending order, so that the first of equal
    super-k-mers of the chunk is its first occurrence.
    """
    _, one = np.unique(keys, return_index=True)  # rows that repeat are one document
    order = one[np.lexsort((keys[one], ids[one]))]
    cut = [words(texts[i]) for i in order.tolist()]
    counts = np.array([len(w) for w in cut], np.int64)
    line = b" ".join([b" ".join(c) for c in cut if c])
    del cut
    values = hashes(line)
    ends = np.cumsum(counts)
    start = np.arange(max(len(values) - WINDOW + 1, 0))
    doc = np.repeat(np.arange(len(counts)), counts)[:len(start)]
    least = minimisers(values, frequent)
    inside = start + WINDOW <= ends[doc] if len(start) else np.zeros(0, bool)
    start, doc, least = start[inside], doc[inside], least[inside]
    if not len(start):
        return [], None
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1] + 1) | (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    n = np.diff(np.append(head, len(start)))
    doc, least, start = doc[head], least[head], start[head]
    at = np.concatenate([[0], np.flatnonzero(np.frombuffer(line, np.uint8) == 32) + 1, [len(line) + 1]])
    strings = [line[a:b - 1] for a, b in zip(at[start].tolist(), at[start + n + WINDOW - 1].tolist())]
    seen: set[bytes] = set()
    first = np.array([s not in seen and not seen.add(s) for s in strings], bool)
    place = start - (ends - counts)[doc]
    again = (keys[order][doc[~first]], place[~first], (place + n + WINDOW - 1)[~first])
    bucket = ((least * ODD[10]) >> np.uint64(33)).astype(np.int64) % buckets
    kept = np.flatnonzero(first)
    kept = kept[np.argsort(bucket[kept], kind="stable")]
    squeeze, out = zstandard.ZstdCompressor(level=5), []
    for part in np.split(kept, np.flatnonzero(np.diff(bucket[kept])) + 1):
        d = order[doc[part]]
        meta = ids[d].tobytes() + keys[d].tobytes() + place[part].astype(np.int32).tobytes()
        out.append((int(bucket[part[0]]), squeeze.compress(b"\n".join([strings[i] for i in part.tolist()])),
                    squeeze.compress(meta)))
    return out, again


ROWS = "bucket int, strings binary, meta binary, again array<struct<key:long,a:int,b:int>>"


def packed_rows(docs: DataFrame, frequent, buckets: int) -> DataFrame:
    """docs (key, id, text) -> rows (bucket, strings, meta) and, without strings,
    repeats found within a chunk (again: key and words [a, b)), in any bucket."""
    run_type = pa.struct([("key", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])
    schema = pa.schema([("bucket", pa.int32()), ("strings", pa.binary()), ("meta", pa.binary()),
                        ("again", pa.list_(run_type))])

    def batches_of(rows, again):
        if rows:
            b, s, m = zip(*rows)
            yield pa.record_batch([pa.array(b, pa.int32()), pa.array(s, pa.binary()), pa.array(m, pa.binary()),
                                   pa.nulls(len(b), schema.field("again").type)], schema=schema)
        if again is not None and len(again[0]):
            runs = pa.StructArray.from_arrays([pa.array(again[0]), pa.array(again[1].astype(np.int32)),
                                               pa.array(again[2].astype(np.int32))], ["key", "a", "b"])
            cuts = np.append(np.arange(0, len(runs), 1 << 12), len(runs))
            n = len(cuts) - 1
            yield pa.record_batch([pa.array(np.abs(again[0][cuts[:-1]] % buckets).astype(np.int32)),
                                   pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
                                   pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), runs)], schema=schema)

    def run(batches):
        hashes, held, size = WordHash(), [], 0

        def done():
            ids, keys = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            yield from batches_of(*packed(ids, keys, [t for h in held for t in h[2]], frequent.value, buckets, hashes))

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            ids, at = batch.column(1).fill_null(NULL_ID).to_numpy(zero_copy_only=False), 0
            for texts in text_bytes(batch.column(2)):
                held.append((ids[at:at + len(texts)], keys[at:at + len(texts)], texts))
                at += len(texts)
                size += sum(map(len, texts))
                if size >= CHUNK_BYTES:
                    yield from done()
                    held, size = [], 0
        if held:
            yield from done()

    return docs.mapInArrow(run, ROWS)


def repeats(rows: pa.Table, hashes: WordHash) -> pa.RecordBatch | None:
    """The super-k-mers of one bucket -> repeats (key, a, b): its windows are
    sorted by word sequence (128 bits) and place."""
    open_ = zstandard.ZstdDecompressor()
    strings, ids, keys, place = [], [], [], []
    for s, m in zip(rows.column("strings").to_pylist(), rows.column("meta").to_pylist()):
        strings.append(open_.decompress(s))
        meta = open_.decompress(m)
        n = len(meta) // 20
        ids.append(np.frombuffer(meta, np.int64, n))
        keys.append(np.frombuffer(meta, np.int64, n, 8 * n))
        place.append(np.frombuffer(meta, np.int32, n, 16 * n))
    ids, keys, place = map(np.concatenate, (ids, keys, place))
    by = np.lexsort((keys, ids))
    doc = np.empty(len(ids), np.int64)  # rank of the document
    doc[by] = np.cumsum(np.concatenate([[0], (np.diff(ids[by]) != 0) | (np.diff(keys[by]) != 0)]))
    line = b"\n".join(strings)
    del strings
    data = np.frombuffer(line, np.uint8)
    gaps = data[(data == 32) | (data == 10)]  # after each word but the last
    counts = np.diff(np.concatenate([[-1], np.flatnonzero(gaps == 10), [len(gaps)]]))
    values = hashes(line.replace(b"\n", b" "))
    n = counts - WINDOW + 1
    piece = np.repeat(np.arange(len(n)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(np.cumsum(counts) - counts, n) + offset
    one, two = (windows_hash(values, WINDOW, int(odd))[at] for odd in ODD[11:13])
    where = (doc[piece] << 32) | (place[piece].astype(np.int64) + offset)
    order = np.lexsort((where, two, one))
    same = np.concatenate([[False], (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])])
    leader = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    late = np.zeros(len(order), bool)
    late[order] = where[order] > where[order][leader]
    if not late.any():
        return None
    edge = np.concatenate([[False], late, [False]])
    fresh = np.concatenate([[True], piece[1:] != piece[:-1], [True]])
    begin = np.flatnonzero(late & (~edge[:-2] | fresh[:-1]))
    end = np.flatnonzero(late & (~edge[2:] | fresh[1:]))
    a = place[piece[begin]] + offset[begin]
    return pa.record_batch({"key": pa.array(keys[piece[begin]]), "a": pa.array(a.astype(np.int32)),
                            "b": pa.array((a + end - begin + WINDOW).astype(np.int32))})


def repeated_runs(docs: DataFrame) -> DataFrame:
    """docs (key, id, text) -> key, runs: the word ranges of repeated windows."""
    spark = docs.sparkSession
    count = slot_counts(docs)
    frequent = spark.sparkContext.broadcast(count > FREQUENT * max(1.0, count.mean()))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = packed_rows(docs, frequent, BUCKETS * partitions)

    def run(batches):
        hashes = WordHash()
        for bucket in grouped(batches, "bucket", 1):
            at_once = bucket.column("again").combine_chunks().flatten()
            if len(at_once):
                yield pa.RecordBatch.from_struct_array(at_once)
            sent = bucket.filter(pa.compute.is_valid(bucket.column("strings")))
            if sent.num_rows and (found := repeats(sent, hashes)) is not None:
                yield found

    return (rows.repartition(partitions, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(run, "key long, a int, b int").groupBy("key")
            .agg(F.collect_set(F.struct("a", "b")).alias("runs")))


def kept_words(tokens: list[bytes], runs) -> list[bytes]:
    gone = np.zeros(len(tokens) + 1, np.int64)
    for r in runs:
        gone[r["a"]] += 1
        gone[r["b"]] -= 1
    covered = np.cumsum(gone[:-1]) > 0
    return [w for w, c in zip(tokens, covered.tolist()) if not c]


STAYS = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                      T.StructField("kept", T.StringType())])


@F.arrow_udf(STAYS)
def stays(text: pa.Array, runs: pa.Array) -> pa.Array:
    total, removed, kept, at = [], [], [], 0
    for texts in text_bytes(text):
        for t, found in zip(texts, runs.slice(at, len(texts)).to_pylist()):
            tokens = words(t)
            left = kept_words(tokens, found) if found else tokens
            total.append(len(tokens))
            removed.append(len(tokens) - len(left))
            kept.append(b" ".join(left).decode())
        at += len(texts)
    return pa.StructArray.from_arrays([pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                                       pa.array(kept, pa.string())], STAYS.names)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept (the words that stay, joined by
    one space).

    ``id_col`` is an integer column. Null ids come before all others; rows of
    the same id are ordered by the hash of id and text; rows that repeat both
    are one document. Null texts have no words. Texts below WINDOW words lose
    nothing.
    """
    rows = batched(docs).select(doc_key(id_col, text_col).alias("key"), F.col(id_col).cast("long").alias("id"),
                       F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"))
    runs = materialize(repeated_runs(rows.select("key", "id", "text")), "repeated-runs")
    # texts that the bit table excludes repeat nothing and need not be shuffled
    rows = rows.withColumn("some", Bits(runs, "key").column("key"))
    joined = rows.where("some").join(runs, "key", "left").select("doc_id", "text", "runs")
    rest = rows.where("not some").select("doc_id", "text", F.lit(None).cast(runs.schema["runs"].dataType).alias("runs"))
    return (joined.unionByName(rest).select("doc_id", stays("text", "runs").alias("s")).select("doc_id", "s.*"))


