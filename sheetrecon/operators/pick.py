"""One row per key.

All picks are ``row_number() = 1`` over a window partitioned by the key.
Catalyst turns ``rn = 1`` into a WindowGroupLimit that is applied both
before the shuffle (partial, per map task) and after it, so a hot key ships
at most one row per map task: a key holding a third of all rows does not
land whole in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values that must match the reference's behaviour: role names ranked
# by the priority pick (compared upper-cased, exact), in rank order.
ROLE_RANKS = ("TITULAR", "PROPIETARIO")
# Substring marking a holder role when counting holders.
HOLDER_MARK = "TITULAR"

# Tie-break after (rank, name) so the pick is deterministic.
DEFAULT_TIEBREAK = ("caracter_titular", "monto", "fecha_contrato", "sucursal")


def role_rank(role: Column | str, ranks: Sequence[str] = ROLE_RANKS) -> Column:
    """1 for the first ranked role, 2 for the second, ..., len+1 otherwise."""
    r = F.col(role) if isinstance(role, str) else role
    up = F.upper(r)
    expr = F.lit(len(ranks) + 1)
    for i, name in reversed(list(enumerate(ranks, start=1))):
        expr = F.when(up == F.lit(name), F.lit(i)).otherwise(expr)
    return expr


def _asc(cols: Sequence[str | Column]) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_first() for c in cols]


def pick_first(df: DataFrame, key: str, order: Sequence[str | Column],
               descending: bool = False) -> DataFrame:
    """First row per ``key`` in ``order`` (nulls first); last row when
    ``descending``."""
    if descending:
        spec = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order]
    else:
        spec = _asc(order)
    w = Window.partitionBy(key).orderBy(*spec)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def priority_pick(df: DataFrame, key: str = "legajo", role: str = "caracter_titular",
                  name: str = "nombre_cliente", tiebreak: Sequence[str] = DEFAULT_TIEBREAK,
                  ranks: Sequence[str] = ROLE_RANKS) -> DataFrame:
    """Per key the party with the best role rank, then by name."""
    tb = [c for c in tiebreak if c in df.columns and c not in (role, name)]
    order = [role_rank(role, ranks), F.col(name), *[F.col(c) for c in [role, *tb]]]
    return pick_first(df, key, order)


def priority_pick_combined(df: DataFrame, key: str = "legajo", role: str = "caracter_titular",
                           holder: str = "titular_cobro", name: str = "cliente",
                           policy: str = "both") -> DataFrame:
    """The combined policy: role rank, then parties with a bank holder
    first, then name. ``policy`` 'role' or 'holder' keeps only one rule."""
    has_holder = F.when(F.col(holder).isNull(), F.lit(1)).otherwise(F.lit(0))
    rules = {"role": [role_rank(role)], "holder": [has_holder],
             "both": [role_rank(role), has_holder]}[policy]
    rest = [c for c in df.columns if c not in (key,)]
    return pick_first(df, key, [*rules, F.col(name), *[F.col(c) for c in rest if c != name]])


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First row per key in (order...) - the seen-set loop."""
    return pick_first(df, key, order)


def last_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Last row per key in an explicit order (the dict-overwrite loop)."""
    return pick_first(df, key, order, descending=True)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's checkpoint dir (the shared
    folder a cluster names in ``spark.checkpoint.dir``): cuts the lineage
    of an input that is read several times, and survives lost executors."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def number_within_key(df: DataFrame, key: str, order: Sequence[str],
                      checkpoint_input: bool = True) -> DataFrame:
    """Ordinal of each row inside its key; key text only on the first.

    Rows are ranked inside their key, one shuffle on it. Keys that hold more rows than a
    range of the sampled order (``order_bounds``) are hot: their rows get range buckets on
    (key, order...) so that such a key spans many buckets and tasks, and ordinal = rank
    inside (bucket, key) + rows of the same key in earlier buckets. Only a key that a bound
    names can lie in two buckets, so those counts are at most one row per bucket. Null keys
    form their own group. The input is read several times (bounds, counts, ranks), so by
    default it is checkpointed once first.
    """
    from .safety import broadcast_if_bounded

    if checkpoint_input:
        df = materialize(df)
    bounds = order_bounds(df, [key, *order])
    named = [b[0] for b in bounds]
    hot = {k for k, next_k in zip(named, named[1:]) if k == next_k}
    bounds = [b for b in bounds if b[0] in hot]
    # the key wrapped in a non-null struct: equal for two null keys, and the
    # same expression partitions the rank window and the join (no reshuffle)
    t = in_buckets(df, [key, *order], bounds).withColumn("_kj", F.struct(F.col(key).alias("k")))
    local = t.withColumn("_local", F.row_number().over(
        Window.partitionBy("_bucket", "_kj").orderBy(*_asc(order))))
    if hot:
        earlier = Window.partitionBy("_kj").orderBy("_bucket").rowsBetween(
            Window.unboundedPreceding, -1)
        is_hot = F.col(key).isin([k for k in hot if k is not None])
        if None in hot:
            is_hot = is_hot | F.col(key).isNull()
        offsets = (t.where(is_hot).groupBy("_bucket", "_kj").agg(F.count(F.lit(1)).alias("_n"))
                   .select("_bucket", "_kj", F.sum("_n").over(earlier).alias("_before")))
        local = local.join(broadcast_if_bounded(offsets, len(bounds) + len(hot)), ["_bucket", "_kj"], "left")
    else:
        local = local.withColumn("_before", F.lit(None).cast("long"))
    return (local.withColumn("n_in_key", F.coalesce("_before", F.lit(0)) + F.col("_local"))
            .withColumn("key_display", F.when(F.col("n_in_key") == 1, F.col(key).cast("string"))
                        .otherwise(F.lit("")))
            .drop("_bucket", "_kj", "_local", "_before"))


def _order_struct(order: Sequence[str | Column]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)])


UNROLL_STEPS = 4
#: ``monotonically_increasing_id`` counts a part's rows in its lower 33 bits.
PLACES = 1 << 33
MIN_BUCKET_ROWS = 200_000


#: Order tuples that are sampled for each range (as Spark's own sort does for a partition).
SAMPLED = 20


def _ranges(df: DataFrame, num_buckets: int | None = None) -> int:
    from .safety import parallelism
    return num_buckets or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                              parallelism(df.sparkSession))


def order_bounds(df: DataFrame, order: Sequence[str | Column],
                 num_buckets: int | None = None) -> list[tuple]:
    """Ascending lower bounds that part the rows into ranges of like size in ``order``.

    One pass draws ``SAMPLED`` order tuples per range at random; they reach the driver, as
    in Spark's own sort sampling. The sample only says where ranges end: every row is still
    dealt, counted and ranked. A range holds about ``MIN_BUCKET_ROWS`` rows or more (but no
    more than 1/parallelism of the rows, so every core gets one; or total / ``num_buckets``
    when a count is given), so small inputs get few ranges and large ones up to one per
    shuffle partition.
    """
    from .safety import parallelism
    n = _ranges(df, num_buckets)
    drawn = (df.select(_order_struct(order).alias("_k"), F.rand(0).alias("_r"))
             .orderBy("_r").limit(SAMPLED * n).orderBy(F.col("_k").asc_nulls_first()).collect())
    if not drawn:
        return []
    total = len(drawn) if len(drawn) < SAMPLED * n else len(drawn) / max(max(r["_r"] for r in drawn), 1e-12)
    target = total / n
    if num_buckets is None:  # big enough to be worth a task, small enough to keep every core busy
        target = max(target, min(MIN_BUCKET_ROWS, math.ceil(total / parallelism(df.sparkSession))))
    step = max(1, math.ceil(target * len(drawn) / total))
    return [tuple(r["_k"]) for r in drawn[step::step]]


def range_buckets(df: DataFrame, order: Sequence[str | Column],
                  num_buckets: int | None = None) -> tuple[DataFrame, int]:
    """Add ``_bucket``: the range bucket of each row's full order tuple, by the bounds of
    ``order_bounds``. Bounds are on the whole tuple, so one hot leading value (a key holding
    a third of all rows) still spreads over many buckets.
    Returns (DataFrame, number of buckets).
    """
    bounds = list(dict.fromkeys(order_bounds(df, order, num_buckets)))
    return in_buckets(df, order, bounds), len(bounds) + 1


def in_buckets(df: DataFrame, order: Sequence[str | Column], bounds: Sequence[tuple]) -> DataFrame:
    """Add ``_bucket``: the number of ``bounds`` (ascending) not above the row's order tuple.

    Found by a binary search (log2(n) projections) in the sorted bounds array: a pure
    function of the row, so every re-evaluation agrees. The array reaches the tasks as a
    one-value scalar subquery over the bounds (one small local relation), not as thousands
    of plan literals.
    """
    if not bounds:
        return df.withColumn("_bucket", F.lit(0))
    spark, key = df.sparkSession, _order_struct(order)
    ktype = df.select(key.alias("_k")).schema["_k"].dataType
    from pyspark.sql.types import IntegerType, StructField, StructType
    bdf = spark.createDataFrame(list(enumerate(bounds)),
                                StructType([StructField("_i", IntegerType()),
                                            StructField("_m", ktype)]))
    arr = bdf.agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_m"))),
                              lambda x: x["_m"])).scalar()
    nb = len(bounds)
    steps = max(1, math.ceil(math.log2(nb + 1)))

    def step(lo, hi, bounds_col, key_col):
        # non-nullable integer arithmetic: no not-null filter gets inferred
        mid = F.shiftright(lo + hi + F.lit(1), 1)
        ok = F.coalesce(key_col >= F.element_at(bounds_col, F.greatest(mid, F.lit(1))),
                        F.lit(False))
        go = lo < hi
        return F.when(go & ok, mid).otherwise(lo), F.when(go & ~ok, mid - 1).otherwise(hi)

    out = df.withColumns({"_bounds": arr, "_key": key})
    if steps <= UNROLL_STEPS:
        # few buckets (every input below a few million rows): the search is
        # unrolled into one projection per step and stays in codegen
        out = out.withColumns({"_lo": F.lit(0), "_hi": F.lit(nb)})
        for _ in range(steps):
            lo, hi = step(F.col("_lo"), F.col("_hi"), F.col("_bounds"), F.col("_key"))
            out = out.withColumns({"_lo": lo, "_hi": hi})
        bucket = F.col("_lo")
    else:
        # many buckets: one fixed-size fold over log2(n) steps (an unrolled
        # chain would grow the optimizer's expression trees with the steps)
        def fold(acc, _):
            lo, hi = step(acc["lo"], acc["hi"], F.col("_bounds"), F.col("_key"))
            return F.struct(lo.alias("lo"), hi.alias("hi"))
        init = F.struct(F.lit(0).alias("lo"), F.lit(nb).alias("hi"))
        bucket = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, fold)["lo"]
    return out.withColumn("_bucket", bucket).drop("_bounds", "_key", "_lo", "_hi")


def ordered_with_position(df: DataFrame, order: Sequence[str | Column], pos: str = "pos",
                          num_buckets: int | None = None, checkpoint_input: bool = True) -> DataFrame:
    """O1/O2: a listing with its 1-based position in ``order`` (nulls first).

    ``row_number`` over an unpartitioned window would pull every row into one
    task. Instead rows are dealt out by ranges of the order tuple, sorted inside their
    range and checkpointed: from then on a row's range is the number of the checkpoint's
    part and its place in the range the place in the part, whatever task reads it, so
    retries and lost executors reproduce the same positions. The position is that place
    plus the rows of earlier ranges (one row per range, broadcast). ``order``
    must be total for positions to be unique among distinct rows. The input is
    read twice (Spark's sort sampling, dealing out), so by default it is checkpointed
    once first: what makes it (scans, joins) runs once.
    """
    from .safety import broadcast_if_bounded

    if checkpoint_input:
        df = materialize(df)
    spec = _asc(order)
    dealt = df.repartitionByRange(num_buckets, *spec) if num_buckets else df.repartitionByRange(*spec)
    t = materialize(dealt.sortWithinPartitions(*spec)).withColumns({
        "_part": F.spark_partition_id(),
        "_place": F.monotonically_increasing_id().bitwiseAND(F.lit(PLACES - 1)) + 1})
    counts = t.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select("_part", (F.sum("_n").over(w) - F.col("_n")).alias("_before"))
    return (t.join(broadcast_if_bounded(offsets, _ranges(df, num_buckets)), "_part")
            .withColumn(pos, F.col("_before") + F.col("_place"))
            .drop("_part", "_place", "_before"))


def running_aggregate(df: DataFrame, value: str, order: Sequence[str], partition: Sequence[str],
                      num_buckets: int | None = None, checkpoint_input: bool = True) -> DataFrame:
    """Running sum (decimal-exact when ``value`` is decimal) and count of
    ``value`` per ``partition`` in ``order``, as ``_run_sum`` / ``_run_n``.

    Parallel prefix sum: range buckets on (partition, order); running sums
    inside (bucket, partition); per (bucket, partition) totals - at most
    #partitions + #buckets rows - get a running offset over earlier buckets
    of the same partition; the offset is joined back. A partition holding a
    third of all rows is spread over many buckets and tasks. The input is
    checkpointed once first, as in ``ordered_with_position``.
    """
    if checkpoint_input:
        df = materialize(df)
    keys = [*partition, *order]
    t, nb = range_buckets(df, keys, num_buckets)
    # partition values wrapped in a non-null struct: null values form their
    # own group, and window and join share one partitioning expression
    t = t.withColumn("_pj", F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(partition)]))
    inner = (Window.partitionBy("_bucket", "_pj").orderBy(*_asc(order))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = (t.withColumn("_ls", F.sum(value).over(inner))
             .withColumn("_ln", F.count(F.lit(1)).over(inner)))
    tot = t.groupBy("_bucket", "_pj").agg(F.sum(value).alias("_bs"), F.count(F.lit(1)).alias("_bn"))
    prior = (Window.partitionBy("_pj").orderBy("_bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    offs = tot.select("_bucket", "_pj",
                      F.coalesce(F.sum("_bs").over(prior), F.lit(0).cast(tot.schema["_bs"].dataType))
                      .alias("_os"),
                      F.coalesce(F.sum("_bn").over(prior), F.lit(0)).alias("_on"))
    out = local.join(offs, ["_bucket", "_pj"], "inner")
    return (out.withColumn("_run_sum", F.col("_os") + F.col("_ls"))
            .withColumn("_run_n", F.col("_on") + F.col("_ln"))
            .drop("_bucket", "_pj", "_ls", "_ln", "_os", "_on"))


def small_ordinal(df: DataFrame, order: Sequence[str | Column], pos: str = "pos") -> DataFrame:
    """Position over a small, bounded set (a top-k or a distinct code list):
    a plain ``row_number`` over one ordered window."""
    return df.withColumn(pos, F.row_number().over(Window.orderBy(*_asc(order))).cast("long"))
