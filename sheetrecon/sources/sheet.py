"""Headerless, ragged, all-text sheet scans that keep row positions.

Spark files carry no line order, so a sheet is read as text lines and each
line gets its 1-based position inside its file:

* every line gets ``monotonically_increasing_id()`` right at the scan, plus
  ``_metadata.file_path`` and ``_metadata.file_block_start``;
* lines of one (file, block) split are contiguous inside one task, so the
  line's position inside the split is ``id - min(id of the split)``;
* a tiny per-split table (one row per split: min id and line count) gets
  the running line count of earlier splits of the same file;
* that table is joined back. It has one row per split, so it is bounded by
  the number of splits, not by the data; the join is broadcast only below
  a checked size.

The same table decides the encoding of each file and where quoted cells span
lines (see ``records``). No step shuffles the sheet itself, but for files with
records of several lines. Blank lines are kept (Spark's CSV reader
would drop them and shift positions). Cells are parsed with ``from_csv``:
short rows are padded with nulls, long rows truncated to ``n_cols``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.safety import split_bound
from . import records as rc

ROW_NO = "row_no"
FILE = "file_path"


def cell_names(n_cols: int) -> list[str]:
    """Sheet column names: c0 (= A), c1 (= B), ..."""
    return [f"c{i}" for i in range(n_cols)]


def sheet_schema(n_cols: int) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cell_names(n_cols)])


def number_lines(spark: SparkSession, path: str | list[str],
                 path_glob: str | None = None) -> DataFrame:
    """Text lines of one or many files with their 1-based line number.

    Returns ``file_path string, row_no bigint, value string``.
    """
    reader = spark.read.format("text")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    scan, bound = raw_scan(reader, path)
    return number_text_scan(scan, bound)


def raw_scan(reader, path: str | list[str]) -> tuple[DataFrame, int]:
    """``file_path, _blk, value`` of a text reader, and the bound on its splits."""
    raw = reader.load(path)
    return raw.select(F.col("_metadata.file_path").alias(FILE),
                      F.col("_metadata.file_block_start").alias("_blk"), "value"), split_bound(raw)


def number_text_scan(scan: DataFrame, row_bound: int | None = None) -> DataFrame:
    """Line numbers and text (in the encoding of its file) for a text scan with
    ``file_path, _blk, value`` columns (a batch read, or one micro-batch of a file stream:
    every file of a micro-batch is complete, so per-file numbering holds there too).

    ``row_bound`` bounds the number of (file, split) pairs; when known and
    small, the per-split offsets table is broadcast.
    """
    return rc.numbered(rc.text_lines(scan), row_bound).drop("_tab")


def parse_lines(lines: DataFrame, n_cols: int, sep: str | None = ",",
                value_col: str = "value", keep: Iterable[str] = (FILE, ROW_NO)) -> DataFrame:
    """Split each text line into ``c0..c{n_cols-1}`` string cells.

    CSV quoting rules apply inside a record. Missing cells and empty unquoted
    cells are null (as a headerless all-text read gives them), a quoted
    empty cell is ''. Extra cells are dropped, an unparsable line gives
    all-null cells (permissive). A blank line gives all-null cells. ``sep=None`` takes
    the separator of each line from its column ``sep`` (a tab or a comma).
    """
    schema = sheet_schema(n_cols).simpleString()

    def cells(one: str) -> Column:
        return F.from_csv(F.col(value_col), schema, {"sep": one, "mode": "PERMISSIVE", "emptyValue": "",
                                                     "escape": '"'})

    parsed = cells(sep) if sep is not None else F.when(F.col("sep") == "\t", cells("\t")).otherwise(cells(","))
    keep = [k for k in keep if k in lines.columns]
    rows = lines.select(*keep, parsed.alias("_cells"))
    return rows.select(*keep, *[F.col("_cells").getField(c).alias(c) for c in cell_names(n_cols)])


def read_sheet(spark: SparkSession, path: str | list[str], n_cols: int, sep: str | None = ",",
               multi_line: bool = True, path_glob: str | None = None,
               max_lines: int = rc.MAX_LINES) -> DataFrame:
    """Robust sheet scan (no header, all text) with ``file_path, row_no``.

    Each file is read as UTF-8 if it is that, else as ISO-8859-1. ``sep=None`` takes the
    separator of each file from its first line. Quoted line breaks stay inside their
    cell (of ``max_lines`` lines at most) and blank records keep their place.
    ``multi_line=False`` takes every line as a record.
    """
    reader = spark.read.format("text")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    scan, bound = raw_scan(reader, path)
    return sheet_of(scan, n_cols, sep, multi_line, bound, max_lines)


def sheet_of(scan: DataFrame, n_cols: int, sep: str | None = ",", multi_line: bool = True,
             row_bound: int | None = None, max_lines: int = rc.MAX_LINES) -> DataFrame:
    """``read_sheet`` of a text scan (``file_path, _blk, value``; or with ``_id``)."""
    lines = scan if "_id" in scan.columns else rc.text_lines(scan)
    if multi_line:
        return parse_lines(rc.records(lines, sep, row_bound, max_lines), n_cols, sep)
    rows = rc.numbered(lines, row_bound)
    if sep is None:
        rows = rows.withColumn("sep", F.when(F.col("_tab"), F.lit("\t")).otherwise(F.lit(",")))
    return parse_lines(rows, n_cols, sep)


def infer_width(lines: DataFrame, sep: str = ",", sample_rows: int | None = None) -> int:
    """Widest line (fields per line) over the first ``sample_rows`` lines.

    An action: returns a Python int (one aggregate row reaches the driver).
    """
    src = lines if sample_rows is None else lines.filter(F.col(ROW_NO) <= sample_rows)
    n = src.agg(F.max(F.size(F.split("value", _re_escape(sep), -1)))).first()[0]
    return int(n or 0)


def _re_escape(sep: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)


def fields_per_line(lines: DataFrame, max_rows: int | None = None,
                    echo_chars: int = 80) -> DataFrame:
    """Per line: separator guess (tab if the line holds a tab, else comma),
    field count, first ``echo_chars`` chars."""
    src = lines if max_rows is None else lines.filter(F.col(ROW_NO) <= max_rows)
    sep = F.when(F.col("value").contains("\t"), F.lit("\t")).otherwise(F.lit(","))
    n = F.when(F.col("value").contains("\t"), F.size(F.split("value", "\t", -1))) \
         .otherwise(F.size(F.split("value", ",", -1)))
    cols = [c for c in (FILE, ROW_NO) if c in lines.columns]
    return src.select(*cols, sep.alias("sep"), n.alias("n_fields"),
                      F.substring("value", 1, echo_chars).alias("head"))


def detect_separator(lines: DataFrame) -> DataFrame:
    """Per file: tab when line 1 contains a tab, else comma."""
    first = lines.filter(F.col(ROW_NO) == 1)
    return first.select(FILE, F.when(F.col("value").contains("\t"), F.lit("\t"))
                        .otherwise(F.lit(",")).alias("sep"))


def clean_null_tokens(df: DataFrame, cols: Iterable[str] | None = None,
                      tokens: Iterable[str] = ("", "NULL", "null", "#N/D")) -> DataFrame:
    """Cells equal to one of ``tokens`` become null (CSV ``nullValue`` takes one)."""
    tokens = list(tokens)
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in (FILE, ROW_NO)]
    return df.select(*[F.when(F.col(c).isin(*tokens), F.lit(None).cast("string"))
                       .otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def read_typed_sheet(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """Sheet with a header line; every named column read as text."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


def data_region(sheet: DataFrame, start_row: int = 11, end_row: int | None = None) -> DataFrame:
    """Rows at or below ``start_row`` (1-based), optionally up to ``end_row``."""
    cond = F.col(ROW_NO) >= start_row
    if end_row is not None:
        cond = cond & (F.col(ROW_NO) <= end_row)
    return sheet.filter(cond)


def head_rows(sheet: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows of every file (deterministic: by row_no, not ``limit``)."""
    return sheet.filter(F.col(ROW_NO) <= n)


def column_at(df: DataFrame, index: int) -> Column:
    """Sheet column by zero-based ordinal (B = 1)."""
    cells = [c for c in df.columns if c not in (FILE, ROW_NO)]
    if index >= len(cells):
        raise ValueError(f"sheet has {len(cells)} columns, column {index} requested")
    return F.col(cells[index])


def require_width(df: DataFrame, min_cols: int) -> DataFrame:
    """Raise a clear error when the sheet has fewer than ``min_cols`` columns."""
    n = len([c for c in df.columns if c not in (FILE, ROW_NO)])
    if n < min_cols:
        raise ValueError(f"sheet has {n} columns, at least {min_cols} needed")
    return df


def append_column(sheet: DataFrame) -> tuple[DataFrame, str]:
    """Add the next free cell column (all null); returns (sheet, its name)."""
    cells = [c for c in sheet.columns if c.startswith("c") and c[1:].isdigit()]
    name = f"c{len(cells)}"
    return sheet.withColumn(name, F.lit(None).cast("string")), name


def target_column(sheet: DataFrame, label: str, header_rows: int = 10) -> tuple[DataFrame, str]:
    """P3 for one sheet: the column whose banner holds ``label``, else a new
    appended column. One small aggregate row reaches the driver."""
    from ..operators.profile import find_label_column
    row = find_label_column(sheet, [label], header_rows).agg(F.min("col_ix").alias("ix")).first()
    cells = [c for c in sheet.columns if c.startswith("c") and c[1:].isdigit()]
    if row is None or row.ix is None or row.ix >= len(cells):
        return append_column(sheet)
    return sheet, cells[row.ix]
