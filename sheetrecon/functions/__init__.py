from .text import (  # noqa: F401
    strip, is_strict_key, is_loose_key, is_decimal_key, is_fillable,
    FILLABLE_TOKENS, FILLABLE_TOKENS_LEGACY,
)
