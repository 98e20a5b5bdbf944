"""Write lookup values back into sheet cells.

The sheet is joined to a one-row-per-key lookup (the output of a pick), so
the join never multiplies sheet rows. The join is a plain left join on the
stripped key cell: Catalyst plans a broadcast when the lookup is small and
a shuffle join otherwise; AQE splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import FILLABLE_TOKENS, is_fillable, is_loose_key, is_strict_key, strip
from ..sources.sheet import FILE, ROW_NO
from .pick import HOLDER_MARK

# Fixed values that must match the reference's behaviour.
UNMATCHED_MESSAGE = "No se encontró datos para propuesta: "

NEW, SAME, OVER, UNMATCHED = "newly_filled", "already_filled", "overwritten", "unmatched"


def sheet_keys(sheet: DataFrame, key_cell: str = "c1", start_row: int = 11,
               predicate: str = "strict", end_row: int | None = None) -> DataFrame:
    """Key occurrences of the data region: ``row_no, key`` (+ file_path).

    ``predicate``: 'strict' (digits, length >= 4), 'loose' (non-empty).
    ``end_row`` bounds the scan window (option; default: all rows).
    """
    pred = is_strict_key(key_cell) if predicate == "strict" else is_loose_key(key_cell)
    cond = (F.col(ROW_NO) >= start_row) & pred
    if end_row is not None:
        cond = cond & (F.col(ROW_NO) <= end_row)
    keep = [c for c in ("file_path", ROW_NO) if c in sheet.columns]
    return sheet.filter(cond).select(*keep, strip(key_cell).alias("key"))


def decimal_keys(sheet: DataFrame, key_cell: str = "c1", start_row: int = 11,
                 end_row: int | None = None, first_n: int | None = None) -> DataFrame:
    """Cells that are digits once every '.' is removed (skip-listed
    labels excluded), with the digits-only key. ``end_row`` bounds the scan
    window and ``first_n`` keeps the first n per file by row (options; the
    reference's diagnostic used rows 11-30 and the first 5)."""
    from pyspark.sql import Window
    from ..functions.text import is_decimal_key
    cond = (F.col(ROW_NO) >= start_row) & is_decimal_key(key_cell)
    if end_row is not None:
        cond = cond & (F.col(ROW_NO) <= end_row)
    keep = [c for c in ("file_path", ROW_NO) if c in sheet.columns]
    out = sheet.filter(cond).select(*keep, F.col(key_cell).alias("key"),
                                    F.replace(F.col(key_cell), F.lit("."), F.lit("")).alias("key_digits"))
    if first_n is not None:
        part = ["file_path"] if "file_path" in out.columns else []
        w = Window.partitionBy(*part).orderBy(ROW_NO)
        out = out.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= first_n).drop("_n")
    return out


def _attach(sheet: DataFrame, lookup: DataFrame, key_cell: str, start_row: int,
            key_col: str, values: Mapping[str, str]) -> DataFrame:
    """Left-join the one-row-per-key ``lookup`` onto data rows of ``sheet``.

    Adds ``_matched`` and one ``_v_<name>`` column per looked-up value.
    """
    lk = lookup.select(F.col(key_col).alias("_lk"),
                       *[F.col(src).alias(f"_v_{name}") for name, src in values.items()])
    s = sheet.withColumn("_k", F.when(F.col(ROW_NO) >= start_row, strip(key_cell)))
    out = s.join(lk, F.col("_k") == F.col("_lk"), "left")
    return out.withColumn("_matched", F.col("_lk").isNotNull()).drop("_lk", "_k")


def fill_column(sheet: DataFrame, lookup: DataFrame, target: str = "c5", key_cell: str = "c1",
                value: str = "nombre_cliente", key_col: str = "legajo", start_row: int = 11,
                overwrite: bool = False, tokens: Iterable[str] = FILLABLE_TOKENS) -> DataFrame:
    """fill blank target cells of matched rows (or overwrite).

    Returns the sheet with ``target`` updated and a ``fill_action`` column:
    newly_filled, already_filled, overwritten, unmatched (a data row whose
    key cell has no lookup row) or null (banner rows).
    """
    j = _attach(sheet, lookup, key_cell, start_row, key_col, {"value": value})
    v = F.col("_v_value")
    cur = F.col(target)
    fillable = is_fillable(cur, tokens)
    same = strip(cur).eqNullSafe(v)
    action = (F.when(F.col(ROW_NO) < start_row, F.lit(None).cast("string"))
              .when(~F.col("_matched"), F.lit(UNMATCHED))
              .when(fillable, F.lit(NEW))
              .when(same, F.lit(SAME))
              .when(F.lit(overwrite), F.lit(OVER))
              .otherwise(F.lit(SAME)))
    j = j.withColumn("fill_action", action)
    write = F.col("fill_action").isin(NEW, OVER)
    cols = [F.when(write, v.cast("string")).otherwise(cur).alias(target) if c == target else F.col(c)
            for c in sheet.columns]
    return j.select(*cols, "fill_action")


def fill_gated(sheet: DataFrame, lookup: DataFrame, targets: Mapping[str, str],
               gate: str = "c5", key_cell: str = "c1", key_col: str = "legajo",
               start_row: int = 11, role: str | None = "caracter_titular",
               tokens: Iterable[str] = FILLABLE_TOKENS) -> DataFrame:
    """when the ``gate`` cell is blank, set every ``targets`` cell
    (sheet column -> lookup column) together. Amounts are written with two
    decimals, dates as yyyy-MM-dd. Adds ``filled`` and ``is_holder``."""
    j = _attach(sheet, lookup, key_cell, start_row, key_col,
                {f"t_{k}": v for k, v in targets.items()} | ({"role": role} if role else {}))
    go = F.col("_matched") & is_fillable(F.col(gate), tokens) & (F.col(ROW_NO) >= start_row)
    out = []
    for c in sheet.columns:
        if c in targets:
            out.append(F.when(go, as_sheet_text(F.col(f"_v_t_{c}"), lookup.schema[targets[c]].dataType))
                       .otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    holder = F.coalesce(F.upper(F.col("_v_role")).contains(HOLDER_MARK), F.lit(False)) if role \
        else F.lit(False)
    return j.select(*out, go.alias("filled"), (go & holder).alias("is_holder"))


def fill_always(sheet: DataFrame, lookup: DataFrame, target: str = "c5", key_cell: str = "c1",
                value: str = "nombre_cliente", key_col: str = "legajo",
                start_row: int = 11, with_key: bool = False) -> DataFrame:
    """every matched data row gets the looked-up value (loose keys). ``with_key`` adds
    the row's key (null where there is none), so that all figures of the run follow
    from the filled rows."""
    j = _attach(sheet, lookup, key_cell, start_row, key_col, {"value": value})
    key = F.when((F.col(ROW_NO) >= start_row) & is_loose_key(key_cell), strip(key_cell))
    cols = [F.when(F.col("_matched"), F.col("_v_value").cast("string")).otherwise(F.col(c)).alias(c)
            if c == target else F.col(c) for c in sheet.columns]
    return j.select(*cols, F.col("_matched").alias("matched"), *([key.alias("key")] if with_key else []))


def observed(filled: DataFrame, **figures: Column) -> tuple[DataFrame, Observation]:
    """``filled`` with aggregates that the job which writes it collects on its way (no
    distinct counts); read them with ``Observation.get`` once it is written."""
    figures = {k: v.alias(k) for k, v in figures.items()}
    watch = Observation()
    return filled.observe(watch, *figures.values()), watch


def as_sheet_text(v: Column, dtype) -> Column:
    """Typed value -> sheet text (decimal(18,2) plain text, dates ISO)."""
    from pyspark.sql.types import DateType, DecimalType, DoubleType, FloatType, TimestampType
    if isinstance(dtype, (DoubleType, FloatType, DecimalType)):
        return v.cast("decimal(18,2)").cast("string")
    if isinstance(dtype, (DateType, TimestampType)):
        return F.date_format(v, "yyyy-MM-dd")
    return v.cast("string")


# ------------------------------------------------------------ membership
def matched_keys(keys: DataFrame, lookup: DataFrame, key_col: str = "legajo") -> DataFrame:
    """Key occurrences that have a lookup row."""
    return keys.join(lookup.select(F.col(key_col).alias("key")).distinct(), "key", "left_semi")


def unmatched_keys(keys: DataFrame, lookup: DataFrame, key_col: str = "legajo") -> DataFrame:
    """One message per key occurrence without a lookup row."""
    miss = keys.join(lookup.select(F.col(key_col).alias("key")).distinct(), "key", "left_anti")
    return miss.withColumn("message", F.concat(F.lit(UNMATCHED_MESSAGE), F.col("key")))


def unmatched_sample(unmatched: DataFrame, n: int = 3) -> DataFrame:
    """First ``n`` unmatched messages by file and row, plus how many more."""
    from .pick import small_ordinal
    top = unmatched.select(FILE, ROW_NO, "message").orderBy(FILE, ROW_NO).limit(n)  # top-k, no full sort
    pos = small_ordinal(top, [FILE, ROW_NO], "pos")
    total = unmatched.agg(F.count(F.lit(1))).scalar()  # scalar subquery, one value
    return pos.select("pos", FILE, ROW_NO, "message",
                      F.greatest(total - F.lit(n), F.lit(0)).alias("more"))


# ------------------------------------------------------------ statistics
def fill_stats(filled: DataFrame, key_cell: str = "c1", start_row: int = 11,
               predicate: str = "strict") -> DataFrame:
    """A4/A5: key occurrences, distinct keys found, per-action counts, rates.

    ``filled`` is the output of ``fill_column``: every data row carries its
    key cell and its ``fill_action`` (``unmatched`` when the key has no
    lookup row), so all figures come from one aggregate over it - the
    lookup is not evaluated a second time.
    """
    data = filled.filter(F.col(ROW_NO) >= start_row)
    is_key = is_strict_key(key_cell) if predicate == "strict" else is_loose_key(key_cell)
    k = strip(key_cell)
    found = is_key & (F.col("fill_action") != UNMATCHED)
    row = data.agg(
        F.count_if(F.col("fill_action") == NEW).alias("newly_filled"),
        F.count_if(F.col("fill_action") == SAME).alias("already_filled"),
        F.count_if(F.col("fill_action") == OVER).alias("overwritten"),
        F.count_if(is_key).alias("total_legajos"),
        F.count_distinct(F.when(is_key, k)).alias("distinct_legajos"),
        F.count_distinct(F.when(found, k)).alias("found_in_db"))
    filled_n = F.col("newly_filled") + F.col("already_filled") + F.col("overwritten")
    return row.select(
        "total_legajos", "distinct_legajos", "found_in_db", "already_filled", "newly_filled",
        "overwritten",
        rate(F.col("found_in_db"), F.col("total_legajos")).alias("efficiency_pct"),
        rate(F.col("found_in_db"), F.col("distinct_legajos")).alias("distinct_efficiency_pct"),
        rate(filled_n, F.col("total_legajos")).alias("fill_pct"))


def rate(num: Column, den: Column) -> Column:
    """Percentage rounded to one decimal; 0 when the denominator is 0."""
    return F.round(F.coalesce(F.try_divide(num.cast("double") * 100.0, den.cast("double")),
                              F.lit(0.0)), 1)


def holder_stats(filled: DataFrame) -> DataFrame:
    """Rows updated by the gated fill and how many are holders."""
    return filled.agg(F.count_if("filled").alias("updated"),
                      F.count_if("is_holder").alias("holders")) \
        .withColumn("holder_pct", rate(F.col("holders"), F.col("updated")))


def batch_counts(keys: DataFrame, lookup: DataFrame, batch_size: int = 100,
                 key_col: str = "legajo") -> DataFrame:
    """Per batch of ``batch_size`` key occurrences (by file and row), how
    many keys were sent and how many distinct keys matched."""
    from .pick import ordered_with_position
    pos = ordered_with_position(keys.select(FILE, ROW_NO, "key"), [FILE, ROW_NO], "pos")
    b = pos.withColumn("batch", F.floor((F.col("pos") - 1) / batch_size).cast("long") + 1)
    lk = lookup.select(F.col(key_col).alias("key")).distinct().withColumn("_hit", F.lit(True))
    return (b.join(lk, "key", "left")
            .groupBy("batch")
            .agg(F.count(F.lit(1)).alias("n_keys"),
                 F.count_distinct(F.when(F.col("_hit"), F.col("key"))).alias("n_matched")))
