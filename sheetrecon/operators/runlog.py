"""Run statistics.

A run log is a DataFrame with one row per processing run. Totals are a
single global aggregate (partial per task, one row shuffled per task).
Sums of seconds are taken as decimal(18,2) so they are exact and do not
depend on summation order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sheet import FILE, ROW_NO
from .fill import UNMATCHED_MESSAGE


def run_log_totals(log: DataFrame, seconds: str = "execution_time", records: str = "records",
                   success: str = "success", group: Sequence[str] = ()) -> DataFrame:
    """Runs, records, errors, total and mean time, records per second."""
    secs = F.col(seconds).cast("decimal(18,2)")
    agg = log.groupBy(*group).agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(F.col(records).cast("long")).alias("total_records"),
        F.count_if(~F.col(success)).alias("errors"),
        F.sum(secs).cast("decimal(38,2)").alias("total_seconds"))
    return (agg.withColumn("avg_seconds",
                           F.round(F.col("total_seconds").cast("double") / F.col("runs"), 6))
            .withColumn("records_per_sec",
                        F.round(F.try_divide(F.col("total_records").cast("double"),
                                             F.col("total_seconds").cast("double")), 6)))


def running_average(log: DataFrame, value: str, order: Sequence[str],
                    partition: Sequence[str] = ()) -> DataFrame:
    """Running mean of ``value`` over the runs logged so far, per
    ``partition`` (empty: one global log). Sums are decimal(18,2), exact.

    Uses a parallel prefix sum (``pick.running_aggregate``), so neither a
    global log nor one source holding most runs is processed by one task.
    """
    from .pick import running_aggregate
    cols = log.columns
    v = log.withColumn("_v", F.col(value).cast("decimal(18,2)"))
    out = running_aggregate(v, "_v", order, partition)
    return out.select(*cols, F.round(F.col("_run_sum").cast("double") / F.col("_run_n"), 6)
                      .alias("running_avg"))


def check_summary(checks: DataFrame, name: str = "check", ok: str = "success",
                  min_passed: int | None = None) -> DataFrame:
    """Passed / failed counts over named checks and the verdict (all
    passed, or at least ``min_passed`` when given)."""
    agg = checks.agg(F.count_if(F.col(ok)).alias("passed"),
                     F.count_if(~F.col(ok)).alias("failed"),
                     F.count(F.lit(1)).alias("total"))
    verdict = (F.col("failed") == 0) if min_passed is None else (F.col("passed") >= min_passed)
    return agg.withColumn("all_ok", verdict)


def table_checks(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Data checks per table: has rows, key never null, key unique.

    ``tables`` maps name -> (DataFrame, key column). One aggregate per
    table, unioned.
    """
    parts: list[DataFrame] = []
    for tname, (df, key) in tables.items():
        a = df.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("nn"),
                   F.count_distinct(key).alias("nd"))
        parts.append(a.select(F.lit(tname).alias("table_name"), F.inline(F.array(
            F.struct(F.lit("has_rows").alias("check"), (F.col("n") > 0).alias("success")),
            F.struct(F.lit("key_not_null").alias("check"), (F.col("nn") == F.col("n")).alias("success")),
            F.struct(F.lit("key_unique").alias("check"), (F.col("nd") == F.col("nn")).alias("success"))))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_summary(keys: DataFrame, lookup: DataFrame, key_col: str = "legajo",
                success: bool = True, execution_time: float | None = None) -> DataFrame:
    """K4/A3: a row per file: success, processed and matched counts, errors (how
    many, and the message of the first), seconds. One join of the keys with the
    lookup's keys and one aggregate; a run that raised passes ``success`` false."""
    hit = lookup.select(F.col(key_col).alias("key")).distinct().withColumn("_hit", F.lit(True))
    rows = keys.join(hit, "key", "left").withColumn("matched", F.col("_hit").isNotNull())
    return summary_of(rows, success, execution_time)


def summary_of(rows: DataFrame, success: bool = True, execution_time: float | None = None) -> DataFrame:
    """``run_summary`` of key occurrences (file_path, row_no, key) that are marked ``matched``
    already, such as the rows of a filled sheet: no lookup is evaluated again."""
    miss = ~F.col("matched")
    return rows.groupBy(FILE).agg(
        F.count(F.lit(1)).alias("processed_count"),
        F.count_if(~miss).alias("matched_count"),
        F.count_if(miss).alias("error_count"),
        F.min_by(F.concat(F.lit(UNMATCHED_MESSAGE), F.col("key")), F.when(miss, F.col(ROW_NO))).alias("first_error"),
    ).select(F.lit(success).alias("success"), "processed_count", "matched_count", "error_count", "first_error",
             FILE, F.lit(execution_time).cast("double").alias("execution_time"))
