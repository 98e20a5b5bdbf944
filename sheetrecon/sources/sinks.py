"""Sheet and run-summary sinks (K1-K4).

A filled sheet is written headerless and in row order: range-partitioned on
(file_path, row_no) and sorted inside partitions, so reading the part files
in name order gives the rows in order, and no task holds a whole sheet (a
sheet with a third of all rows is written by many tasks). ``per_sheet=True``
writes one folder per input sheet, same ordering. A generated header line
(K2) is added as a data row at position 0 of each sheet, so it lands first
in that sheet's first part file without a single-task write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.fmt import basename
from ..operators.safety import broadcast_if_bounded
from .sheet import FILE, ROW_NO


def sheet_cells(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("c") and c[1:].isdigit()]


def sheet_id(path):
    """Folder name of a sheet's output: its file name and a hash of its path."""
    return F.concat_ws("-", basename(path), F.lpad(F.lower(F.hex(F.xxhash64(path))), 16, "0"))


def write_sheet(df: DataFrame, out_dir: str, sep: str = ",", header: bool = False,
                per_sheet: bool = False, num_parts: int | None = None,
                mode: str = "overwrite", manifest: bool = False) -> None:
    """Write sheet cells (c0..cN) as CSV: nulls and '' both as empty fields. A
    manifest needs mode "overwrite": appended parts have no order among themselves."""
    if manifest and mode != "overwrite":
        raise ValueError("a manifest covers one write: use mode='overwrite'")
    cells = sheet_cells(df)
    data = df.select(FILE, ROW_NO, *cells)
    if header:
        names = data.select(FILE).distinct().select(
            FILE, F.lit(0).cast("long").alias(ROW_NO), *[F.lit(c).alias(c) for c in cells])
        data = names.unionByName(data)
    n = num_parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if per_sheet:
        # The writer needs rows grouped by the partition column; ordering by
        # (sheet, file, row) satisfies that, so it adds no (unstable) sort.
        # the name alone is not unique: sheets of other folders may share it
        keyed = data.withColumn("sheet", sheet_id(F.col(FILE)))
        order = ["sheet", FILE, ROW_NO]
        ordered = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order)
        writer = ordered.select("sheet", *cells).write.partitionBy("sheet")
    else:
        ordered = data.repartitionByRange(n, FILE, ROW_NO).sortWithinPartitions(FILE, ROW_NO)
        writer = ordered.select(*cells).write
    (writer.mode(mode).option("sep", sep).option("header", False)
     .option("escape", '"').option("emptyValue", "").option("nullValue", "").csv(out_dir))
    if manifest:
        write_manifest(df.sparkSession, out_dir)


#: Folder of the manifest; a name that readers of the sheet skip.
MANIFEST = "_manifest"


def write_run_log(summary: DataFrame, table_dir: str) -> None:
    """Append run-summary rows (K4) to a parquet run log."""
    summary.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(table_dir)


def _below():
    """The path of a part file below the folder of its write, from its whole path."""
    tail = F.split("path", "/")
    folder = F.when(F.element_at(tail, -2).startswith("sheet="), F.element_at(tail, -2))
    return F.concat_ws("/", folder, F.element_at(tail, -1))


def write_manifest(spark: SparkSession, out_dir: str) -> None:
    """(sheet, part_no, part, start, length) of the parts of a finished write, in row
    order; ``sheet`` is '' for a write that is not per sheet. It is written after the
    parts are committed, and an overwrite of ``out_dir`` removes it with them: a manifest
    never describes parts of another write. Empty parts are listed too. Offsets are a
    window per sheet, over a row per part."""
    number = F.regexp_extract("part", r"part-(\d+)", 1).cast("long")
    order = Window.partitionBy("sheet").orderBy("number", "part")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.csv").load(out_dir)
    sheet = F.col("sheet").cast("string") if "sheet" in files.columns else F.lit("")
    rows = (files.select(sheet.alias("sheet"), _below().alias("part"), "length")
            .withColumn("number", number).withColumn("part_no", F.row_number().over(order) - 1)
            .withColumn("start", F.sum("length").over(order) - F.col("length")))
    rows.select("sheet", "part_no", "part", "start", "length").write.mode("overwrite").parquet(f"{out_dir}/{MANIFEST}")


def read_manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    """The manifest of a write (see ``write_manifest``); fails where a write has none."""
    return spark.read.parquet(f"{out_dir}/{MANIFEST}")


def sheet_parts(spark: SparkSession, out_dir: str, sheet: str | None = None,
                first: int = 0, last: int | None = None) -> DataFrame:
    """(sheet, part_no, start, content): the bytes of each part that the manifest lists, of
    one or all sheets, or those that bytes ``first`` to ``last`` (exclusive) of the sheet
    touch. Contents in order of ``start`` are the sheet, byte for byte; files that a failed
    attempt left are not read. The driver holds the paths of the parts. A listed part that is missing or has another length fails
    the job."""
    wanted = read_manifest(spark, out_dir).where(F.col("start") + F.col("length") > first)
    if sheet is not None:
        wanted = wanted.where(F.col("sheet") == sheet)
    if last is not None:
        wanted = wanted.where(F.col("start") < last)
    wanted = wanted.select("sheet", "part_no", "start", "part", F.col("length").alias("size"))
    paths = [f"{out_dir.rstrip('/')}/{r.part}" for r in wanted.select("part").collect()]
    if not paths:
        return wanted.select("sheet", "part_no", "start", F.lit(None).cast("binary").alias("content"))
    found = spark.read.format("binaryFile").load(paths).select(_below().alias("part"), "length", "content")
    whole = F.when(F.col("size") == F.col("length"), F.col("content")).otherwise(
        F.raise_error(F.concat(F.lit("part differs from the manifest: "), "part")).cast("binary"))
    return (found.join(broadcast_if_bounded(wanted, len(paths)), "part")
            .select("sheet", "part_no", "start", whole.alias("content")))
