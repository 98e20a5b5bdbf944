"""Directory listing and test-sheet generation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sheet import FILE, ROW_NO, cell_names

# Fixed values that must match the reference's behaviour: generated sheets
# start their keys here and carry this label in column B of the banner.
GENERATED_FIRST_KEY = 642799
GENERATED_KEY_LABEL = "PROPUESTA JKM"


def list_sheets(spark: SparkSession, folder: str, pattern: str = "*.csv",
                exclude_prefix: str | None = "test_") -> DataFrame:
    """Sheet files of a folder with size in MB (contents not read)."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
          .select(F.col("path").alias(FILE), F.col("length").alias("size_bytes")))
    name = F.element_at(F.split(FILE, "/"), -1)
    if exclude_prefix:
        df = df.filter(~name.startswith(exclude_prefix))
    return df.select(FILE, name.alias("name"), "size_bytes",
                     F.round(F.col("size_bytes") / (1024 * 1024), 2).alias("size_mb"))


def generate_sheet(spark: SparkSession, num_rows: int, banner_rows: int = 10,
                   n_cols: int = 4, first_key: int = GENERATED_FIRST_KEY) -> DataFrame:
    """A sheet of ``banner_rows`` banner rows and ``num_rows`` data rows;
    key i is ``first_key`` + i in column B, other cells derived text.

    Distributed: ``spark.range`` spreads the rows over tasks.
    """
    cols = cell_names(n_cols)
    banner = spark.range(1, banner_rows + 1).select(
        F.lit("generated://sheet.csv").alias(FILE), F.col("id").alias(ROW_NO),
        *[(F.when(F.col("id") == banner_rows, F.lit(GENERATED_KEY_LABEL if i == 1 else f"COL{i}"))
           .otherwise(F.concat(F.lit("BANNER "), F.col("id"))) if i < 2 else F.lit(None).cast("string"))
          .alias(c) for i, c in enumerate(cols)])
    data = spark.range(num_rows).select(
        F.lit("generated://sheet.csv").alias(FILE), (F.col("id") + banner_rows + 1).alias(ROW_NO),
        *[(F.concat(F.lit("R"), F.col("id")) if i == 0 else
           (F.col("id") + first_key).cast("string") if i == 1 else
           F.lit(None).cast("string")).alias(c) for i, c in enumerate(cols)])
    return banner.unionByName(data)


def sheet_summary(sheet: DataFrame, lines: DataFrame, key_cell: str = "c1",
                  first_row: int = 11, last_row: int = 13, n_samples: int = 2) -> DataFrame:
    """Per file rows, columns, and the non-blank key cells of a few
    data rows (count and first ``n_samples``)."""
    from ..functions.text import strip
    from ..operators.profile import sheet_dims
    win = sheet.filter((F.col(ROW_NO) >= first_row) & (F.col(ROW_NO) <= last_row))
    v = strip(key_cell)
    keys = (win.filter(F.coalesce(F.length(v) > 0, F.lit(False)))
            .groupBy(FILE).agg(F.count(F.lit(1)).alias("n_keys"),
                               F.slice(F.sort_array(F.collect_list(F.struct(ROW_NO, v.alias("v")))),
                                       1, n_samples).alias("_s"))
            .select(FILE, "n_keys", F.transform("_s", lambda s: s["v"]).alias("key_samples")))
    return sheet_dims(lines).join(keys, FILE, "left")
