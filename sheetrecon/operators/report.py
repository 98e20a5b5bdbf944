"""Sheet profile and its text report.

``profile`` builds one row per file from one aggregate over the sheet, one
over its lines and the first key samples (all partial, so a huge sheet is
never gathered in one task) and ``profile_report`` renders it as text with plain column expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fmt
from ..functions.text import has_special_chars, strip
from ..sources.sheet import FILE, ROW_NO
from .profile import cell_columns, first_keys, quality_level

# Fixed values that must match the reference's behaviour (format warnings).
RAGGED_WARNING = "[WARNING] Inconsistencia en número de columnas por fila"
SPECIAL_WARNING = "[WARNING] Caracteres especiales detectados en columna B"


def file_stats(lines: DataFrame) -> DataFrame:
    """Per file: bytes (with line ends), rows, widest row."""
    return lines.groupBy(FILE).agg(
        F.sum(F.octet_length("value") + 1).alias("size_bytes"),
        F.count(F.lit(1)).alias("total_rows"),
        F.max(F.size(F.split("value", ",", -1))).alias("total_cols"))


def profile(sheet: DataFrame, lines: DataFrame, key_cell: str = "c1",
            start_row: int = 11) -> DataFrame:
    """Per file: size, dimensions, format issues, key analysis, quality,
    strategy and time estimate, as nested structs."""
    st = file_stats(lines).withColumn("file_size_mb", F.col("size_bytes") / (1024.0 * 1024.0))
    cols = cell_columns(sheet)
    data = F.col(ROW_NO) >= start_row
    valid = F.coalesce(F.length(strip(key_cell)) > 0, F.lit(False))
    blank = sum((F.col(c).isNull() | (strip(c) == "")).cast("int") for c in cols)
    width = sum(F.col(c).isNotNull().cast("int") for c in cols)
    # one aggregate; the set holds at most one entry per column count
    per_file = sheet.groupBy(FILE).agg(
        F.sum(blank).alias("empty_cells"), F.count(F.lit(1)).alias("rows_seen"),
        F.size(F.collect_set(width)).alias("distinct_widths"),
        F.count_if(data & valid).alias("valid"), F.count_if(data & ~valid).alias("empty"),
        F.count_if(data & has_special_chars(key_cell)).alias("n_special"))
    pct = F.round(F.col("empty_cells") * 100.0 / (F.col("rows_seen") * len(cols)), 4)
    score = F.round(F.greatest(F.lit(0.0), F.lit(100.0) - F.col("empty_pct")), 4)
    q = (per_file.withColumn("empty_pct", pct).withColumn("quality_score", score)
         .withColumn("quality_level", quality_level(F.col("quality_score")))
         .withColumn("ragged", (F.col("rows_seen") > 10) & (F.col("distinct_widths") > 2))
         .withColumn("has_special", F.col("n_special") > 0))
    k = first_keys(sheet, key_cell, start_row)
    issues = F.filter(F.array(F.when(F.col("ragged"), F.lit(RAGGED_WARNING)),
                              F.when(F.col("has_special"), F.lit(SPECIAL_WARNING))),
                      lambda x: x.isNotNull())
    j = st.join(q, FILE).join(k, FILE, "left")
    return j.select(
        FILE, "file_size_mb", "total_rows", "total_cols",
        issues.alias("format_issues"),
        F.struct(F.coalesce("valid", F.lit(0)).alias("valid"),
                 F.coalesce("empty", F.lit(0)).alias("empty"),
                 F.coalesce("sample_values", F.array().cast("array<string>")).alias("sample_values"))
        .alias("propuesta_analysis"),
        F.struct("empty_pct", "quality_score", "quality_level").alias("data_quality"),
        fmt.size_strategy(F.col("file_size_mb"), F.col("total_rows")).alias("performance"),
        fmt.time_estimate(F.col("total_rows")).alias("estimate"))


def _f1(c):
    """One decimal, half to even (Python's '.1f')."""
    return F.format_string("%.1f", F.bround(c.cast("double"), 1))


def profile_report(sheet: DataFrame, lines: DataFrame) -> DataFrame:
    """Per file: the profile as report text, one line per item."""
    p = profile(sheet, lines)
    pa, dq, pf = F.col("propuesta_analysis"), F.col("data_quality"), F.col("performance")
    head = F.array(
        F.concat(F.lit("REPORTE DE ANALISIS: "), fmt.basename(F.col(FILE))),
        F.concat(F.lit("Tamano: "), _f1(F.col("file_size_mb")), F.lit(" MB")),
        F.concat(F.lit("Dimensiones: "), F.format_number(F.col("total_rows"), 0), F.lit(" filas x "),
                 F.col("total_cols").cast("string"), F.lit(" columnas")),
        F.concat(F.lit("Claves validas: "), pa["valid"].cast("string"), F.lit(", vacias: "),
                 pa["empty"].cast("string"), F.lit(", ejemplos: "),
                 F.array_join(F.slice(pa["sample_values"], 1, 3), ", ")),
        F.concat(F.lit("Calidad: "), _f1(dq["quality_score"]), F.lit("/100 ("), dq["quality_level"],
                 F.lit("), celdas vacias: "), _f1(dq["empty_pct"]), F.lit("%")),
        F.concat(F.lit("Estrategia: "), F.initcap(pf["strategy"]), F.lit(", memoria estimada: "),
                 _f1(pf["memory_estimate_mb"]), F.lit(" MB")),
        F.concat(F.lit("Tiempo estimado: "), F.col("estimate.human_readable")))
    return p.select(FILE, F.array_join(F.concat(head, F.col("format_issues")), "\n").alias("report"))
