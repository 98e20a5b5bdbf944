"""Structured Streaming variants.

T1 - incremental fill: new sheets landing in a folder are read as text
lines with ``_metadata.file_path`` / ``file_block_start``. Each micro-batch
holds whole files, so inside ``foreachBatch`` the batch is staged once (its lines as bytes, with their splits) and
then read exactly as a batch read is: records over quoted line breaks, the encoding
and the separator of each file, line numbers. It is filled against the static lookup and
written. The write is keyed by batch id (overwrite of that batch's folder),
so a retried batch replaces its own output: exactly-once files.

``stream_sheet_lines`` is the pure-streaming variant (whole-text rows and
``posexplode``) for pipelines that stay streaming after numbering; it
holds a file in one row, so it suits sheet-sized files.

T2 - running run-log totals: a streaming global aggregate in complete mode.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.runlog import run_log_totals
from ..plans.pipeline import FillRequest, fill_sheet
from ..sources.records import text_lines
from ..sources.sheet import FILE, ROW_NO, sheet_of


def stream_sheet_lines(spark: SparkSession, landing: str, pattern: str = "*.csv",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming lines of newly landed sheets: ``file_path, row_no, value``."""
    reader = (spark.readStream.format("text").option("wholetext", True)
              .option("pathGlobFilter", pattern))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(landing).select(F.col("_metadata.file_path").alias(FILE), "value")
    # A trailing newline ends the last line; it does not start a new one.
    body = F.regexp_replace("value", r"\r?\n\z", "")
    return files.select(FILE, F.posexplode(F.split(body, r"\r?\n")).alias("_pos", "value")) \
        .select(FILE, (F.col("_pos") + 1).cast("long").alias(ROW_NO), "value")


def stream_checkpoint(spark: SparkSession, out_dir: str) -> str:
    """Default checkpoint location of a stream writing ``out_dir``: a folder
    named after the output under the session's ``spark.checkpoint.dir`` (the
    cluster's shared folder), stable across restarts so a restarted stream
    resumes where it stopped."""
    import hashlib

    from ..session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{hashlib.sha1(out_dir.encode()).hexdigest()[:16]}"


def start_incremental_fill(spark: SparkSession, landing: str, catalog: Mapping[str, DataFrame],
                           out_dir: str, checkpoint: str | None, n_cols: int, sep: str | None = ",",
                           req: FillRequest = FillRequest(), available_now: bool = True):
    """Start T1; returns the StreamingQuery. ``checkpoint=None`` uses
    ``stream_checkpoint(spark, out_dir)``."""
    checkpoint = checkpoint or stream_checkpoint(spark, out_dir)
    scan = (spark.readStream.format("text").option("pathGlobFilter", "*.csv").load(landing)
            .select(F.col("_metadata.file_path").alias(FILE),
                    F.col("_metadata.file_block_start").alias("_blk"), "value"))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # the batch before is committed: two staging folders serve all batches
        staged = f"{checkpoint}/staged/{batch_id % 2}"
        lines = text_lines(batch).withColumn("value", F.col("value").cast("binary"))
        lines.write.mode("overwrite").parquet(staged)
        lines = batch.sparkSession.read.schema(lines.schema).parquet(staged)
        sheet = sheet_of(lines.withColumn("value", F.col("value").cast("string")), n_cols, sep)
        filled = fill_sheet(sheet, catalog, req)
        filled.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    w = scan.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def running_totals(log_stream: DataFrame, run_id: str | None = None, event_time: str = "logged_at",
                   watermark: str = "1 hour", **kw) -> DataFrame:
    """Streaming run-log totals (output mode 'complete' or 'update'). With ``run_id`` a
    run counts once, however often its row comes again within ``watermark`` (a file that is
    delivered twice); the ids kept for that are dropped as the watermark passes."""
    if run_id is not None:
        log_stream = log_stream.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark([run_id])
    return run_log_totals(log_stream, **kw)
