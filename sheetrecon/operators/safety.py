"""Size-checked broadcast.

A side is broadcast only when the optimizer's size estimate for it is below
a limit; otherwise the plan keeps a shuffle join (and AQE may still switch
to a broadcast at run time from real sizes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BYTES = 64 * 1024 * 1024


def parallelism(spark) -> int:
    """Cores the session can run at once (shuffle partitions when the
    context is not reachable, e.g. over Spark Connect)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (optimized plan stats), or None."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # noqa: BLE001 - no JVM plan (e.g. Spark Connect)
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when its estimated size is at most ``max_bytes``."""
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


def broadcast_if_bounded(df: DataFrame, row_bound: int, row_bytes: int = 256,
                         max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` when a proven row bound keeps it under ``max_bytes``.

    Use when the caller knows more than the optimizer (for example one row
    per input split); beyond the bound the join stays a shuffle join.
    """
    if row_bound * row_bytes <= max_bytes:
        return F.broadcast(df)
    return df


#: Bits of a key set's table: 4,096 bitmaps of 4 KB, 16 MB whatever the number of keys.
TABLE_BITS = 27


def maybe_member(df: DataFrame, col: Column, keys: DataFrame, key: Column) -> DataFrame:
    """Rows of ``df`` whose ``col`` may be one of ``key`` of ``keys`` (none that is goes; few
    others stay, the fuller the table the more): the hash of every key sets a bit in bitmaps
    of bounded size, which are broadcast, so the rows are cut before any shuffle. Null keys
    and null ``col`` match nothing."""
    def slot(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(1 << TABLE_BITS))

    table = (keys.where(key.isNotNull()).select(slot(key).alias("_slot"))
             .groupBy(F.bitmap_bucket_number("_slot").alias("_bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits")))
    columns = df.columns
    tested = df.where(col.isNotNull()).withColumn("_slot", slot(col))
    place = F.bitmap_bit_position("_slot")
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, place.bitwiseAND(7).cast("int")) == 1
    return (tested.join(F.broadcast(table), F.bitmap_bucket_number("_slot") == F.col("_bucket"))
            .where(hit).select(*columns))


def split_bound(scan: DataFrame) -> int:
    """Upper bound on the number of (file, block) splits of a file scan.

    Every split is either the last piece of a file (at most one per file) or
    a full ``maxPartitionBytes`` piece, and every partition holds at most one
    full piece, so splits <= files + partitions.
    """
    try:
        return len(scan.inputFiles()) + scan.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view: unknown bound, no broadcast
        return 1 << 40


def planned_partitions(df: DataFrame) -> int | None:
    """Partition count of ``df``'s physical plan, read from the plan without
    running it (``df.rdd`` would execute adaptive query stages)."""
    try:
        return int(df._jdf.queryExecution().executedPlan().outputPartitioning().numPartitions())
    except Exception:  # noqa: BLE001 - no JVM plan (e.g. Spark Connect)
        return None

