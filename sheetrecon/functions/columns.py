"""Column letters <-> ordinals (P2). Base 26, so AA follows Z."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def letter_of(index: int) -> str:
    """0 -> 'A', 25 -> 'Z', 26 -> 'AA'."""
    if index < 0:
        raise ValueError("column index must be >= 0")
    out = ""
    n = index + 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def index_of(name: str) -> int:
    """'A' -> 0, 'B' -> 1, 'AA' -> 26."""
    n = 0
    for ch in name.strip().upper():
        if not "A" <= ch <= "Z":
            raise ValueError(f"not a column letter: {name!r}")
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def letter(ix: Column) -> Column:
    """Column expression: ordinal -> letter, for ordinals below 702 (A..ZZ)."""
    hi = F.floor(ix / 26)
    one = F.char(F.lit(65) + ix % 26)
    return F.when(ix < 26, one).otherwise(F.concat(F.char(F.lit(64) + hi), one))
