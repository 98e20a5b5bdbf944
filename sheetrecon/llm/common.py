"""Small helpers shared by the operators: table access, scratch tables in the
cluster's shared folder, batches of bounded size, word splitting."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Text bytes that one step inside a task works on at a time.
STEP_BYTES = 1 << 20
#: Rows of an Arrow batch.
BATCH_ROWS = 1000
#: The same where rows are a few numbers.
NARROW_ROWS = 1 << 15
#: Spark's setting to delete the shuffle files of a query when it ends (others stay until
#: the driver happens to collect its garbage).
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Scratch tables written inside the innermost ``settled`` of this thread.
WRITTEN: ContextVar[list[str] | None] = ContextVar("WRITTEN", default=None)
#: Paths of the scratch tables that are in use.
PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a shared table and read it back (cuts the lineage, so a
    lost executor costs no recomputation of what led here). Its shuffles go at once."""
    spark = df.sparkSession
    path = scratch(spark, name)
    if (written := WRITTEN.get()) is not None:
        written.append(path)
    with setting(spark, CLEANUP, "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    PATHS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more."""
    for df in tables:
        delete(df.sparkSession, PATHS.pop(df))


def settled(name: str, make: Callable[..., DataFrame], *args) -> DataFrame:
    """``make(*args)`` as a scratch table ``name``. The scratch tables that were written on
    the way are deleted: nothing but the result may read them afterwards."""
    outer = WRITTEN.get()
    token = WRITTEN.set(inner := [])
    try:
        out = materialize(make(*args), name)
    finally:
        WRITTEN.reset(token)
        if outer is not None:
            outer += inner  # what an error leaves goes with the outer ones
    for path in inner[:-1]:
        delete(out.sparkSession, path)
        if outer is not None:
            outer.remove(path)
    return out


def delete(spark: SparkSession, path: str) -> None:
    """Delete a scratch table. It stays where the session has no JVM (Spark Connect)."""
    if (jvm := getattr(spark, "_jvm", None)) is not None:
        path = jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """``name`` set to ``value`` meanwhile."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def batched(docs: DataFrame) -> DataFrame:
    """``docs``, after bounding the Arrow batches of its session: texts are long,
    and a task holds a batch on both sides of the Python boundary."""
    conf = docs.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 * STEP_BYTES))
    return docs


def narrow_batches(docs: DataFrame) -> AbstractContextManager[None]:
    """Larger Arrow batches (NARROW_ROWS) for what runs meanwhile: rows of a few numbers."""
    return setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(NARROW_ROWS))


def release() -> None:
    """Give memory that a finished task freed back to the system: Python workers live on,
    and their executors count what they keep."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: nothing to trim


def text_bytes(column: pa.Array) -> Iterator[list[bytes]]:
    """The texts of an Arrow string array as UTF-8 bytes (null: empty), in
    lists of about STEP_BYTES at most (a longer text alone)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not (pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type)
                             else pa.binary())
    start, size = 0, 0
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(sizes.tolist()):
        if size and size + n > STEP_BYTES:
            yield [x or b"" for x in column.slice(start, i - start).to_pylist()]
            start, size = i, 0
        size += n
    if start < len(column):
        yield [x or b"" for x in column.slice(start).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text (what bytes.split takes)."""
    return text.split()


def doc_key(id_col: str, text_col: str):
    """Identity of a row: 64-bit hash of id and text. Rows that repeat both are
    the same document; equal or null ids with other texts stay apart."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each consecutive run of ``lengths`` values (empty runs: 0)."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


class Bits:
    """A set of 64-bit hashes as a bit table of bounded size: ``has`` is true for
    every member and for few others (for more, the fuller the table)."""

    #: 2 ** 27 bits, 16 MB, whatever the number of members.
    SIZE = 27

    def __init__(self, members: DataFrame, column: str):
        slot = F.shiftrightunsigned(F.col(column), 64 - self.SIZE)
        rows = (members.select(slot.alias("slot"))
                .groupBy(F.shiftright("slot", 6).cast("int").alias("word"))
                .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toArrow())
        words = np.zeros(1 << self.SIZE - 6, np.int64)
        words[rows["word"].to_numpy()] = rows["bits"].to_numpy()
        self.sent = members.sparkSession.sparkContext.broadcast(words)

    @staticmethod
    def has(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes.view(np.uint64) >> np.uint64(64 - Bits.SIZE)).astype(np.int64)
        return (words[slot >> 6] >> (slot & 63) & 1).astype(bool)

    def column(self, name: str):
        """Column: may the hash in ``name`` be a member?"""
        sent = self.sent

        @F.arrow_udf("boolean")
        def run(hashes: pa.Array) -> pa.Array:
            return pa.array(Bits.has(sent.value, hashes.to_numpy(zero_copy_only=False)))

        return run(F.col(name))


#: Base of the word hash and its inverse modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
#: Bytes that one pass of the word hash takes (a longer word alone).
PIECE = 1 << 20


def powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, base, np.uint64)]))


class WordHash:
    """64-bit hashes of all words of a buffer at once: a polynomial of the bytes,
    from prefix sums, and a mix of the result."""

    def __init__(self):
        self.up, self.down = powers(BASE, PIECE), powers(UNBASE, PIECE)

    def __call__(self, line: bytes) -> np.ndarray:
        """Hashes of words that single blanks separate."""
        data = np.frombuffer(line, np.uint8)
        if not len(data):
            return np.zeros(0, np.uint64)
        ends = np.append(np.flatnonzero(data == 32), len(data))
        starts = np.concatenate([[0], ends[:-1] + 1])
        out, i = np.empty(len(ends), np.uint64), 0
        while i < len(ends):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
            out[i:j] = self.piece(data[starts[i]:ends[j - 1]], starts[i:j] - starts[i], ends[i:j] - starts[i])
            i = j
        return out

    def piece(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) > len(self.up):
            self.up, self.down = powers(BASE, 2 * len(data)), powers(UNBASE, 2 * len(data))
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=prefix[1:])
        h = (prefix[ends] - prefix[starts]) * self.down[np.minimum(starts, len(self.down) - 1)]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))
