"""Batch job: fill every sheet under a path against a catalog, write the
filled sheets and a per-file summary, append to the run log.

The filled sheet is written once to a staging parquet folder under the
output (shared storage), and both the CSV output and the summary are read
from it, so the lookup pipeline runs once and a lost executor only redoes
its own tasks.

    python -m sheetrecon.plans.jobs --sheets s3://in/*.csv --catalog-parquet s3://db/ \
        --out s3://out/run1 --cols 30 --target c5=nombre_cliente --target c21=monto
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fill import observed, rate
from ..sources.sheet import FILE, read_sheet
from ..sources.sinks import write_run_log, write_sheet
from .pipeline import FillRequest, fill_sheet


def summarize(filled: DataFrame, req: FillRequest) -> DataFrame:
    """Per file: data rows, key cells, filled rows, holders, fill rate."""
    from ..functions.text import is_strict_key
    data = filled.filter(F.col("row_no") >= req.start_row)
    return (data.groupBy(FILE).agg(
        F.count(F.lit(1)).alias("data_rows"),
        F.count_if(is_strict_key(req.key_cell)).alias("key_cells"),
        F.count_if("filled").alias("filled"),
        F.count_if("is_holder").alias("holders"))
        .withColumn("fill_pct", rate(F.col("filled"), F.col("key_cells"))))


def run_fill_job(spark: SparkSession, sheets: str, catalog: Mapping[str, DataFrame], out_dir: str,
                 n_cols: int, req: FillRequest = FillRequest(), sep: str | None = ",",
                 run_log_dir: str | None = None) -> DataFrame:
    """Fill, write, summarize. With ``run_log_dir`` one row per run is logged (K4),
    also when the run fails: then ``success`` is false and the error is kept."""
    t0 = time.time()
    try:
        out, figures = _fill_job(spark, sheets, catalog, out_dir, n_cols, req, sep)
        done = spark.range(1).select(F.lit(True).alias("success"), *[F.lit(v or 0).cast("long").alias(k)
                                                                     for k, v in figures.items()],
                                     F.lit(None).cast("string").alias("first_error"))
    except Exception as e:
        done = spark.range(1).select(F.lit(False).alias("success"), F.lit(0).cast("long").alias("processed_count"),
                                     F.lit(0).cast("long").alias("matched_count"), F.lit(str(e)).alias("first_error"))
        _log(done, sheets, t0, run_log_dir)
        raise
    _log(done, sheets, t0, run_log_dir)
    return out


def _log(done: DataFrame, sheets: str, t0: float, run_log_dir: str | None) -> None:
    if run_log_dir:
        write_run_log(done.select(
            "*", F.col("processed_count").alias("records"), F.lit(sheets).alias("file_path"),
            F.lit(round(time.time() - t0, 3)).alias("execution_time")), run_log_dir)


def _fill_job(spark: SparkSession, sheets: str, catalog: Mapping[str, DataFrame], out_dir: str,
              n_cols: int, req: FillRequest, sep: str | None) -> tuple[DataFrame, dict]:
    """The summary, and the run's figures as the job that writes the staged sheet saw them."""
    from ..functions.text import is_strict_key
    sheet = read_sheet(spark, sheets, n_cols, sep)
    staged = f"{out_dir}/_staged"
    is_key = (F.col("row_no") >= req.start_row) & is_strict_key(req.key_cell)
    rows, watch = observed(fill_sheet(sheet, catalog, req),
                           processed_count=F.count_if(is_key), matched_count=F.count_if("filled"))
    rows.write.mode("overwrite").parquet(staged)
    figures = watch.get
    filled = spark.read.parquet(staged)
    write_sheet(filled, f"{out_dir}/sheets", sep=sep or ",", per_sheet=True)
    summary = summarize(filled, req)
    summary.write.mode("overwrite").parquet(f"{out_dir}/summary")
    return spark.read.parquet(f"{out_dir}/summary"), figures


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Fill sheets from a lookup catalog")
    ap.add_argument("--sheets", required=True)
    ap.add_argument("--catalog-parquet", required=True, help="root with one folder per table")
    ap.add_argument("--out", required=True)
    ap.add_argument("--cols", type=int, required=True)
    ap.add_argument("--sep", default=",")
    ap.add_argument("--key-cell", default="c1")
    ap.add_argument("--gate", default="c5")
    ap.add_argument("--target", action="append", default=[], help="cell=lookup_column")
    ap.add_argument("--start-row", type=int, default=11)
    ap.add_argument("--run-log")
    a = ap.parse_args(argv)
    from ..session import get_session
    from ..sources.tables import parquet_catalog
    spark = get_session()
    targets = dict(t.split("=", 1) for t in a.target) or {a.gate: "nombre_cliente"}
    req = FillRequest(key_cell=a.key_cell, gate=a.gate, targets=targets, start_row=a.start_row)
    run_fill_job(spark, a.sheets, parquet_catalog(spark, a.catalog_parquet), a.out, a.cols, req,
                 a.sep, a.run_log).show(truncate=False)


if __name__ == "__main__":
    main()
