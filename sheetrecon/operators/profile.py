"""Sheet profiling and key-column search (A8-A12, A15, P3, P15, P16, C10,
C13, C19).

Everything starts from ``cells``: the sheet unpivoted to one row per cell
(``file_path, row_no, col_ix, value``), then a single aggregate per file
or per column. Samples are bounded by ``row_no``, never by ``limit``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import letter
from ..functions.text import has_special_chars, is_strict_key, strip
from ..sources.sheet import FILE, ROW_NO

# Fixed values that must match the reference's behaviour.
QUALITY_LEVELS = ((90, "Excelente"), (70, "Buena"), (50, "Regular"))
QUALITY_LOWEST = "Necesita revisión"


def cell_columns(sheet: DataFrame) -> list[str]:
    return [c for c in sheet.columns if c not in (FILE, ROW_NO) and c.startswith("c")]


def cells(sheet: DataFrame, max_cols: int | None = None, include_nulls: bool = True) -> DataFrame:
    """One row per cell: ``file_path, row_no, col_ix, value``."""
    cols = cell_columns(sheet)[:max_cols] if max_cols else cell_columns(sheet)
    stacked = F.inline(F.array(*[F.struct(F.lit(i).alias("col_ix"), F.col(c).alias("value"))
                                 for i, c in enumerate(cols)]))
    out = sheet.select(FILE, ROW_NO, stacked)
    return out if include_nulls else out.filter(F.col("value").isNotNull())


def _rows(sheet: DataFrame, first_row: int | None, last_row: int | None) -> DataFrame:
    if first_row is not None:
        sheet = sheet.filter(F.col(ROW_NO) >= first_row)
    if last_row is not None:
        sheet = sheet.filter(F.col(ROW_NO) <= last_row)
    return sheet


def quality(sheet: DataFrame, first_row: int | None = None, last_row: int | None = None) -> DataFrame:
    """Per file, % of empty cells (null or blank after strip) over
    the rows seen, score = max(0, 100 - empty %), and its level."""
    cols = cell_columns(sheet)
    src = _rows(sheet, first_row, last_row)
    empty_in_row = sum((F.col(c).isNull() | (strip(c) == "")).cast("int") for c in cols)
    per_file = src.groupBy(FILE).agg(F.sum(empty_in_row).alias("empty_cells"),
                                     F.count(F.lit(1)).alias("rows_seen"))
    pct = F.round(F.col("empty_cells") * 100.0 / (F.col("rows_seen") * len(cols)), 4)
    score = F.greatest(F.lit(0.0), F.lit(100.0) - F.col("empty_pct"))
    out = per_file.withColumn("empty_pct", pct).withColumn("quality_score", F.round(score, 4))
    return out.withColumn("quality_level", quality_level(F.col("quality_score")))


def quality_level(score):
    expr = F.lit(QUALITY_LOWEST)
    for threshold, name in reversed(QUALITY_LEVELS):
        expr = F.when(score >= threshold, F.lit(name)).otherwise(expr)
    return expr


def ragged_check(sheet: DataFrame, first_row: int | None = None,
                 last_row: int | None = None) -> DataFrame:
    """Per file, the number of distinct non-null-cell counts per row; the
    sheet is flagged ragged when there are more than 2 (files with more than
    10 rows only)."""
    cols = cell_columns(sheet)
    src = _rows(sheet, first_row, last_row)
    nn = sum(F.col(c).isNotNull().cast("int") for c in cols)
    per_file = src.groupBy(FILE).agg(F.count_distinct(nn).alias("distinct_widths"),
                                     F.count(F.lit(1)).alias("n_rows"))
    return per_file.withColumn("ragged", (F.col("n_rows") > 10) & (F.col("distinct_widths") > 2))


def key_profile(sheet: DataFrame, key_cell: str = "c1", start_row: int = 11,
                end_row: int | None = None, n_samples: int = 5) -> DataFrame:
    """A10: per file over the data rows: non-blank key cells, blank ones,
    and the first ``n_samples`` non-blank values (stripped) by row."""
    src = _rows(sheet, start_row, end_row)
    valid = F.coalesce(F.length(strip(key_cell)) > 0, F.lit(False))
    firsts = first_keys(sheet, key_cell, start_row, end_row, n_samples)
    counts = src.groupBy(FILE).agg(F.count_if(valid).alias("valid"),
                                   F.count_if(~valid).alias("empty"))
    return counts.join(firsts, FILE, "left")


def first_keys(sheet: DataFrame, key_cell: str = "c1", start_row: int = 11,
               end_row: int | None = None, n_samples: int = 5) -> DataFrame:
    """Per file the first ``n_samples`` non-blank key cells (stripped) by row."""
    v = strip(key_cell)
    w = Window.partitionBy(FILE).orderBy(ROW_NO)
    return (_rows(sheet, start_row, end_row).filter(F.coalesce(F.length(v) > 0, F.lit(False)))
            .select(FILE, ROW_NO, v.alias("v"))
            .withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n_samples)
            .groupBy(FILE).agg(F.sort_array(F.collect_list(F.struct(ROW_NO, "v"))).alias("_s"))
            .select(FILE, F.transform("_s", lambda s: s["v"]).alias("sample_values")))


def key_counts(sheet: DataFrame, max_cols: int | None, min_len: int = 4) -> DataFrame:
    """Per file and column with any: ``n_keys`` strict keys. One aggregate with a
    counter per column, then a row per column of that one row per file."""
    cols = cell_columns(sheet)[:max_cols]
    per_file = sheet.groupBy(FILE).agg(*[F.count_if(is_strict_key(c, min_len)).alias(f"_n{i}")
                                         for i, c in enumerate(cols)])
    stacked = F.inline(F.array(*[F.struct(F.lit(i).alias("col_ix"), F.col(f"_n{i}").alias("n_keys"))
                                 for i in range(len(cols))]))
    return per_file.select(FILE, stacked).filter("n_keys > 0")


def score_key_columns(sheet: DataFrame, first_row: int = 10, last_row: int | None = None,
                      max_cols: int | None = None, min_len: int = 4) -> DataFrame:
    """Per file and column, how many cells are strict keys; columns
    sorted by count, the best flagged (lowest column wins ties)."""
    scored = key_counts(_rows(sheet, first_row, last_row), max_cols, min_len)
    w = Window.partitionBy(FILE).orderBy(F.col("n_keys").desc(), F.col("col_ix"))
    return (scored.withColumn("rank", F.row_number().over(w).cast("long"))
            .withColumn("col_letter", letter(F.col("col_ix")))
            .withColumn("is_best", F.col("rank") == 1))


def cells_by_column(sheet: DataFrame, first_row: int = 1, last_row: int | None = None,
                    max_cols: int | None = None, per_column: int = 10) -> DataFrame:
    """Strict-key cells grouped by column, the first ``per_column`` of
    each, with how many more the column holds."""
    rows = _rows(sheet, first_row, last_row)
    hits = (cells(rows, max_cols, include_nulls=False).filter(is_strict_key("value"))
            .select(FILE, ROW_NO, "col_ix", strip("value").alias("value")))
    # top-k per column (partial top-k before the shuffle) and totals by a
    # partial aggregate: no column's cells are gathered in one task.
    w = Window.partitionBy(FILE, "col_ix").orderBy(ROW_NO)
    top = hits.withColumn("pos", F.row_number().over(w).cast("long")).filter(F.col("pos") <= per_column)
    return (top.join(key_counts(rows, max_cols), [FILE, "col_ix"])
            .withColumn("more", F.greatest(F.col("n_keys") - per_column, F.lit(0)))
            .drop("n_keys"))


def search_cells(sheet: DataFrame, text: str | None = None, numeric: bool = False,
                 max_cols: int | None = None, first_row: int | None = None,
                 last_row: int | None = None) -> DataFrame:
    """Cells holding ``text`` (upper-cased, stripped, substring) or
    strict keys, with their coordinates."""
    c = cells(_rows(sheet, first_row, last_row), max_cols, include_nulls=False)
    if numeric:
        c = c.filter(is_strict_key("value"))
    else:
        c = c.filter(F.upper(strip("value")).contains(text.upper()))
    return c.withColumn("col_letter", letter(F.col("col_ix")))


def find_label_column(sheet: DataFrame, labels: Sequence[str], header_rows: int = 10) -> DataFrame:
    """Per file and label, the first column whose first ``header_rows``
    rows hold a cell equal to the label; the next free column when none does
    (the caller appends a column there)."""
    width = len(cell_columns(sheet))
    spark = sheet.sparkSession
    lab = spark.createDataFrame([(x,) for x in labels], "label string")
    head = cells(sheet.filter(F.col(ROW_NO) <= header_rows), include_nulls=False)
    found = (head.join(F.broadcast(lab), head["value"] == lab["label"])
             .groupBy(FILE, "label").agg(F.min("col_ix").alias("col_ix")))
    files = sheet.filter(F.col(ROW_NO) == 1).select(FILE).distinct()
    per_file = files.select(FILE, F.explode(F.array(*[F.lit(x) for x in labels])).alias("label"))
    return (per_file.join(found, [FILE, "label"], "left")
            .select(FILE, "label", F.coalesce("col_ix", F.lit(width)).alias("col_ix"),
                    F.col("col_ix").isNull().alias("appended")))


def sheet_dims(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Per file exact row count and widest row (fields per line)."""
    from ..sources.sheet import _re_escape
    return lines.groupBy(FILE).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.max(F.size(F.split("value", _re_escape(sep), -1))).alias("total_cols"))


def special_chars(sheet: DataFrame, key_cell: str = "c1", start_row: int = 11) -> DataFrame:
    """Per file, key cells holding a quote, CR or LF."""
    src = sheet.filter(F.col(ROW_NO) >= start_row)
    return src.groupBy(FILE).agg(F.count_if(has_special_chars(key_cell)).alias("n_special")) \
        .withColumn("has_special", F.col("n_special") > 0)
