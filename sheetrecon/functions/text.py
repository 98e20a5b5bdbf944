"""Column expressions on sheet text. All JVM-side, no Python UDFs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's behaviour.
# Cell texts treated as "blank" by the fill step (after strip). A null cell
# counts too, since the reference compares str(None) == 'None'.
FILLABLE_TOKENS = ("", "CLIENTE", "nan", "None", "null")
# The older four-token variant (no 'null').
FILLABLE_TOKENS_LEGACY = ("", "CLIENTE", "nan", "None")
# Cell texts the decimal-tolerant key scan skips.
KEY_SKIP_TOKENS = ("", "PROPUESTA JKM", "NUMERO")

# Unicode whitespace as Python's str.strip() sees it: White_Space plus the
# four C0 separators U+001C..U+001F.
_WS = r"[\s\x{1C}-\x{1F}]"
_STRIP_RE = rf"(?U)\A{_WS}+|{_WS}+\z"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Python ``str.strip()`` on a string column (null stays null)."""
    return F.regexp_replace(_c(c), _STRIP_RE, "")


def as_text(c: Column | str) -> Column:
    """Python ``str(x)`` of a possibly-null string cell: null -> 'None'."""
    return F.coalesce(_c(c), F.lit("None"))


def is_strict_key(c: Column | str, min_len: int = 4) -> Column:
    """Stripped cell is ASCII digits only, at least ``min_len`` long."""
    return F.coalesce(strip(c).rlike(rf"\A[0-9]{{{min_len},}}\z"), F.lit(False))


def is_loose_key(c: Column | str) -> Column:
    """Stripped cell is non-empty."""
    return F.coalesce(F.length(strip(c)) > 0, F.lit(False))


def is_decimal_key(c: Column | str, skip: Iterable[str] = KEY_SKIP_TOKENS) -> Column:
    """Digits, or digits once every '.' is removed; skip-listed texts excluded.

    The cell is compared raw (the reference does not strip here).
    """
    col = _c(c)
    digits = F.regexp_replace(col, r"\.", "").rlike(r"\A[0-9]+\z")
    return F.coalesce(~col.isin(*skip) & digits, F.lit(False))


def is_fillable(c: Column | str, tokens: Iterable[str] = FILLABLE_TOKENS) -> Column:
    """Cell counts as blank: null, or its stripped text is one of ``tokens``."""
    col = _c(c)
    return col.isNull() | F.coalesce(strip(col).isin(*list(tokens)), F.lit(False))


def has_special_chars(c: Column | str) -> Column:
    """Cell holds a double quote, CR or LF."""
    return F.coalesce(_c(c).rlike('["\\r\\n]'), F.lit(False))


def clip(c: Column | str, width: int = 20) -> Column:
    """First ``width`` chars, plus '...' when the text is longer; null -> ''."""
    col = F.coalesce(_c(c), F.lit(""))
    return F.when(F.length(col) > width,
                  F.concat(F.substring(col, 1, width), F.lit("..."))).otherwise(col)
