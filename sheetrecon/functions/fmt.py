"""Scalar formatting and classification expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's behaviour.
# Error text -> suggestion, first match wins (lower-cased substring test).
ERROR_SUGGESTIONS = (
    ("network request to host",
     "Verificar que el servicio de Firebird esté ejecutándose y el puerto 3050 esté abierto"),
    ("no such file or directory", "Verificar la ruta del archivo .fdb en DATABASE_CONFIG"),
    ("your user name and password", "Verificar usuario y contraseña en DATABASE_CONFIG"),
    ("connection timeout", "Verificar conectividad de red al servidor Firebird"),
)
ERROR_DEFAULT = "Revisar configuración de Firebird y permisos de archivo"
# Size strategy: (above MB, strategy, chunk size, memory factor); else standard.
SIZE_TIERS = ((100, "streaming", 5000, 0.3), (10, "chunked", 10000, 0.8))
SIZE_DEFAULT = ("standard", None, 1.5)
# Assumed processing rate, records per second.
BASE_RATE = 3000


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def classify_message(msg: Column | str) -> Column:
    """C4: suggestion for an error text (case-insensitive substring)."""
    low = F.lower(_c(msg))
    expr = F.lit(ERROR_DEFAULT)
    for needle, text in reversed(ERROR_SUGGESTIONS):
        expr = F.when(F.coalesce(low.contains(needle), F.lit(False)), F.lit(text)).otherwise(expr)
    return expr


def bank_code(c: Column | str) -> Column:
    """C5: '0' when missing, else 'C.' followed by the code's text."""
    col = _c(c)
    return F.when(col.isNull(), F.lit("0")).otherwise(F.concat(F.lit("C."), col.cast("string")))


def blank_if_falsy(c: Column | str) -> Column:
    """Null, '' and numeric 0 become ''; anything else its text. A text '0' is
    not a zero: what counts is the column's type."""
    col = _c(c)
    is_number = ~F.typeof(col).isin("string", "binary", "date", "timestamp", "boolean")
    zero = is_number & F.coalesce(col.cast("string").try_cast("double") == 0, F.lit(False))
    return F.when(col.isNull() | zero, F.lit("")).otherwise(col.cast("string"))


def zero_if_falsy(c: Column | str) -> Column:
    """Amount as double, 0.0 when null or unparsable."""
    return F.coalesce(_c(c).cast("string").try_cast("double"), F.lit(0.0))


def label_or(c: Column | str, default: str, width: int | None = None) -> Column:
    """Text clipped to ``width`` chars, ``default`` when null or empty."""
    col = _c(c).cast("string")
    if width is not None:
        col = F.substring(col, 1, width)
    return F.when(F.coalesce(F.length(col) > 0, F.lit(False)), col).otherwise(F.lit(default))


def thousands(c: Column | str, decimals: int) -> Column:
    """Python's ``f'{x:,.Nf}'`` (round half to even)."""
    return F.format_number(F.bround(_c(c).cast("decimal(38,10)"), decimals), decimals)


def size_strategy(size_mb: Column | str, rows: Column | str) -> Column:
    """C11: struct(strategy, chunk_size, memory_estimate_mb) by file size."""
    mb = _c(size_mb)
    strat, chunk, mem = F.lit(SIZE_DEFAULT[0]), _c(rows).cast("long"), mb * SIZE_DEFAULT[2]
    for above, name, size, factor in reversed(SIZE_TIERS):
        strat = F.when(mb > above, F.lit(name)).otherwise(strat)
        chunk = F.when(mb > above, F.lit(size).cast("long")).otherwise(chunk)
        mem = F.when(mb > above, mb * factor).otherwise(mem)
    return F.struct(strat.alias("strategy"), chunk.alias("chunk_size"),
                    F.round(mem, 1).alias("memory_estimate_mb"))


def time_estimate(rows: Column | str, rate: int = BASE_RATE) -> Column:
    """struct(seconds, minutes, text) for ``rows`` at ``rate``/s.

    Text as the reference prints it: whole seconds under a minute, minutes
    with one decimal under an hour, else hours with one decimal; rounding
    half to even as Python does.
    """
    sec = _c(rows).cast("double") / rate
    text = (F.when(sec < 60, F.concat(F.bround(sec, 0).cast("long").cast("string"), F.lit(" segundos")))
            .when(sec < 3600, F.concat(F.format_number(F.bround(sec / 60, 1), 1), F.lit(" minutos")))
            .otherwise(F.concat(F.format_number(F.bround(sec / 3600, 1), 1), F.lit(" horas"))))
    return F.struct(sec.alias("estimated_seconds"), (sec / 60).alias("estimated_minutes"),
                    text.alias("human_readable"))


def processed_path(path: Column | str) -> Column:
    """C14: '<name>.csv' -> '<name>_processed.csv'."""
    return F.regexp_replace(_c(path), r"\.csv$", "_processed.csv")


def basename(path: Column | str) -> Column:
    """C14: last path segment."""
    return F.element_at(F.split(_c(path), "/"), -1)
