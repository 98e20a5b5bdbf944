"""Token ids in ORC files (operator 8).

Documents are range-partitioned and sorted by id, encoded with the tokenizers
library, and written as ORC: integer run-length encoded id lists, row indexes,
and Bloom filters on the document id. Readers work stripe by stripe in
parallel, and a filter on document ids skips stripes by their metadata.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batched, materialize, scratch, text_bytes

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'")
#: Distinct words that a worker keeps before it forgets the older half.
CACHE = 1 << 20
#: The run-length encoding has packed the ids already: a light codec is enough.
ORC = {"orc.compress": "LZ4", "orc.create.index": "true", "orc.row.index.stride": "1000",
       "orc.stripe.size": str(32 << 20), "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The model as its file says, which of its ids end a word, and its added tokens."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    vocab = model.get_vocab()
    ends = np.zeros(max(vocab.values()) + 1, bool)
    ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
    added = re.compile(b"|".join(re.escape(t.content.lower().encode()) for t in model.get_added_tokens_decoder().values())
                       or rb"(?!)")
    return model, ends, added


class WordEncoder:
    """Ids of texts by a tokenizer that lower-cases and drops white space, so
    that a text's ids are those of its words, one after the other. The library cuts out
    added tokens before that: a text that holds one is given to it whole."""

    def __init__(self, path: str):
        self.model, self.ends, self.added = tokenizer(path)
        self.known: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        low = [t.lower() for t in texts]
        whole = [i for i, t in enumerate(low) if b"<" in t and self.added.search(t)]
        for i in whole:
            low[i] = b""
        out = self.of_words(low)
        if whole:
            some = self.model.encode_batch([texts[i].decode() for i in whole], add_special_tokens=False)
            for i, found in zip(whole, some):
                out[i] = np.array(found.ids, np.uint32)
        return out

    def of_words(self, texts: list[bytes]) -> list[np.ndarray]:
        cut = [t.split() for t in texts]
        words = list(chain.from_iterable(cut))
        if len(self.known) > CACHE:
            self.known = dict(islice(self.known.items(), CACHE // 2, None))
        ids = list(map(self.known.get, words))
        if None in ids:
            self.learn_new({w for w, i in zip(words, ids) if i is None})
            ids = [self.known[w] if i is None else i for w, i in zip(words, ids)]
        ends = list(accumulate(map(len, cut)))
        return [np.frombuffer(b"".join(ids[a:b]), np.uint32) for a, b in zip([0, *ends], ends)]

    def learn_new(self, new: set[bytes]) -> None:
        """ASCII marks (but not the apostrophe) after an ASCII letter are a token run of
        their own, so such words are learned in two parts."""
        parts = {w: (stem, w[len(stem):]) for w in new
                 if len(stem := w.rstrip(MARKS)) < len(w) and stem[-1:].isalpha()}
        need = {w for w in new if w not in parts}.union(*parts.values()).difference(self.known)
        plain, other = [], []
        for w in need:
            (plain if (s := w.decode()).isalpha() else other).append(s)
        for at in range(0, len(plain), 1 << 12):
            self.learn(plain[at:at + (1 << 12)])
        self.learn_each(other)
        for w, (stem, marks) in parts.items():
            self.known[w] = self.known[stem] + self.known[marks]

    def learn(self, letters: list[str]) -> None:
        """Words of letters only, as one text: each ends with the only token of it
        that ends a word."""
        ids = np.array(self.model.encode_batch_fast([" ".join(letters)], add_special_tokens=False)[0].ids, np.uint32)
        cuts = 4 * (np.flatnonzero(self.ends[ids]) + 1)
        if len(cuts) != len(letters):
            return self.learn_each(letters)
        data, at = ids.tobytes(), 0
        for word, end in zip(letters, cuts.tolist()):
            self.known[word.encode()] = data[at:end]
            at = end

    def learn_each(self, pieces: list[str]) -> None:
        for at in range(0, len(pieces), 1 << 12):
            some = pieces[at:at + (1 << 12)]
            for word, found in zip(some, self.model.encode_batch_fast(some, add_special_tokens=False)):
                self.known[word.encode()] = np.array(found.ids, np.uint32).tobytes()


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def ids_udf(path: str, end_id: int):
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoder(path)  # words learned in one task serve the next ones of this worker
        end = np.array([end_id], np.uint32)
        for text in batches:
            parts = [np.concatenate([ids, end]) for texts in text_bytes(text) for ids in coder.encode(texts)]
            sizes = np.cumsum([0, *map(len, parts)])
            values = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
            yield pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values.astype(np.int32)))

    return run


def write_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
              tokenizer: str = TOKENIZER, end_id: int = END_ID) -> str:
    """Write doc_id, part (number of the range), ids, in ascending doc_id order
    over and within the parts; null ids first, ties by text hash. A null text is
    empty: its ids are the end id."""
    rows = batched(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("tie"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
     .select("doc_id", "tie", F.spark_partition_id().alias("part"), ids_udf(tokenizer, end_id)("text").alias("ids"))
     .write.options(**ORC).orc(path))
    return path


def read_ids(spark: SparkSession, path: str, doc_ids: list | None = None) -> DataFrame:
    """The written rows; with ``doc_ids`` only theirs (pushed to the ORC reader,
    which skips stripes and row groups by their statistics and Bloom filters)."""
    rows = spark.read.orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


@F.arrow_udf(T.LongType())
def crc32_of(ids: pa.Array) -> pa.Array:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    cuts = ids.offsets.to_numpy()
    data = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
    return pa.array([zlib.crc32(data[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])], pa.int64())


def placed_ids(rows: DataFrame) -> DataFrame:
    """Rows that read_ids gives -> doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32. Sums within a part run over narrow rows of that part;
    parts are added up from one total each."""
    counted = rows.select("doc_id", "tie", "part", F.size("ids").cast("long").alias("n_tokens"),
                          crc32_of("ids").alias("ids_crc32"))
    inside = Window.partitionBy("part").orderBy("doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counted = materialize(counted, "id-counts")
    totals = (counted.groupBy("part").agg(F.sum("n_tokens").alias("total"))
              .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")))
    return (counted.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(totals, "part")
            .select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"))


def id_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             path: str | None = None) -> DataFrame:
    """Write the ids of ``docs`` (into the shared folder unless ``path`` is given)
    and return, per document, what the files hold: doc_id, start, n_tokens,
    ids_crc32. Repeated rows keep a place each; an empty table gives no rows."""
    spark = docs.sparkSession
    return placed_ids(read_ids(spark, write_ids(docs, path or scratch(spark, "ids"), id_col, text_col)))
