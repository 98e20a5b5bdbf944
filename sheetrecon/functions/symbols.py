"""Symbol-to-text normalization and byte decoding.

``normalize_symbols`` folds the replacement map into chained ``replace``
calls (JVM-side), then one ``regexp_replace`` turns every remaining run of
emoji into a single marker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's behaviour: symbol -> text,
# every entry in the reference's order. Some symbols are listed twice; as in
# a Python dict, the later text wins and the first position is kept.
SYMBOL_TEXT_ENTRIES = (
    ("🚀", "[INICIO]"), ("✅", "[OK]"), ("❌", "[ERROR]"), ("⚠️", "[AVISO]"),
    ("🔧", "[CONFIG]"), ("📦", "[INSTALL]"), ("🔍", "[BUSCAR]"), ("📊", "[DATOS]"),
    ("🧪", "[TEST]"), ("💡", "[INFO]"), ("📋", "[LISTA]"), ("📄", "[ARCHIVO]"),
    ("📁", "[CARPETA]"), ("🎯", "[TARGET]"), ("🎉", "[EXITO]"), ("🔄", "[PROCESO]"),
    ("💾", "[GUARDAR]"), ("🔌", "[CONEXION]"), ("⏱️", "[TIEMPO]"), ("📝", "[NOTA]"),
    ("🛠️", "[HERRAMIENTAS]"), ("🧩", "[CHUNKS]"), ("📈", "[CHART]"), ("🔗", "[LINK]"),
    ("⌨️", "[TECLADO]"), ("🛑", "[STOP]"), ("👋", "[SALUDO]"), ("🥇", "[PRIMERO]"),
    ("💻", "[PC]"), ("📺", "[MONITOR]"), ("🔋", "[BATERIA]"), ("⬆️", "[UP]"),
    ("⬇️", "[DOWN]"), ("➡️", "[DERECHA]"), ("⬅️", "[IZQUIERDA]"), ("🌟", "[ESTRELLA]"),
    ("💪", "[FUERZA]"), ("🎪", "[CIRCO]"), ("🔥", "[FUEGO]"), ("⚡", "[RAYO]"),
    ("💯", "[100]"), ("🎮", "[JUEGO]"), ("🎨", "[ARTE]"), ("🍕", "[PIZZA]"),
    ("☕", "[CAFE]"), ("🍺", "[CERVEZA]"), ("🎵", "[MUSICA]"), ("📱", "[MOVIL]"),
    ("💰", "[DINERO]"), ("🏆", "[TROFEO]"), ("🎪", "[EVENTO]"), ("🚗", "[AUTO]"),
    ("✈️", "[AVION]"), ("🏠", "[CASA]"), ("🌍", "[MUNDO]"), ("🔮", "[CRISTAL]"),
    ("⭐", "[STAR]"), ("🔴", "[ROJO]"), ("🟢", "[VERDE]"), ("🟡", "[AMARILLO]"),
    ("🔵", "[AZUL]"), ("⚫", "[NEGRO]"), ("⚪", "[BLANCO]"),
    ("\U0001f6e0\ufe0f", "[HERRAMIENTAS]"), ("\U0001f4ca", "[GRAFICO]"), ("\U0001f680", "[COHETE]"),
    ("\u2705", "[CHECK]"), ("\u274c", "[X]"), ("\u26a0\ufe0f", "[WARNING]"),
)
SYMBOL_TEXT = tuple(dict(SYMBOL_TEXT_ENTRIES).items())
EMOJI_MARK = "[EMOJI]"
# Residual emoji, limited to emoji blocks (the reference's class also
# swallowed box drawing and CJK text; see README).
EMOJI_RANGES = (
    (0x1F600, 0x1F64F), (0x1F300, 0x1F5FF), (0x1F680, 0x1F6FF), (0x1F1E0, 0x1F1FF),
    (0x1F900, 0x1F9FF), (0x1FA70, 0x1FAFF), (0x2600, 0x27BF), (0x2B00, 0x2B55),
    (0x200D, 0x200D), (0x23CF, 0x23CF), (0x23E9, 0x23E9), (0x231A, 0x231A),
    (0xFE0F, 0xFE0F), (0x3030, 0x3030),
)


def emoji_class() -> str:
    """Regex character class (Java and RE2 syntax) matching a run of emoji."""
    parts = [f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in EMOJI_RANGES]
    return "[" + "".join(parts) + "]+"


def symbol_lead_class() -> str:
    """Regex class of the first code point of every mapped symbol: a text
    without any of them has nothing for the replacement chain to do."""
    leads = sorted({ord(sym[0]) for sym, _ in SYMBOL_TEXT})
    return "[" + "".join(f"\\x{{{cp:X}}}" for cp in leads) + "]"


def normalize_symbols(c: Column | str) -> Column:
    """Replace known symbols by their text, then each run of other
    emoji by ``[EMOJI]``. The chain of replacements (one pass per symbol)
    runs only on texts that hold a symbol's first code point; the rest pay
    for one regex scan."""
    col = F.col(c) if isinstance(c, str) else c
    chained = col
    for sym, text in SYMBOL_TEXT:
        chained = F.replace(chained, F.lit(sym), F.lit(text))
    replaced = F.when(col.rlike(symbol_lead_class()), chained).otherwise(col)
    return F.regexp_replace(replaced, emoji_class(), EMOJI_MARK)


def decode_text(b: Column | str) -> Column:
    """C17: bytes -> text. Valid UTF-8 is decoded (a leading BOM dropped);
    anything else is read as ISO-8859-1, which never fails."""
    raw = F.col(b) if isinstance(b, str) else b
    is_utf8 = F.is_valid_utf8(raw.cast("string"))
    text = F.when(is_utf8, raw.cast("string")).otherwise(F.decode(raw, "ISO-8859-1"))
    return F.regexp_replace(text, "\\A\uFEFF", "")
