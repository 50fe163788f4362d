"""Column expressions shared by the operators (all JVM-side built-ins)."""

from .numeric import half_even_int, parse_decimal_comma, safe_ratio
from .periods import (MONTH_LABELS, MONTH_NUMBERS, period_from_filename,
                      period_label, period_of)
from .text import blank_key, sanitize_header, strip_odd_lot_suffix, ticker_from_product

__all__ = [
    "half_even_int", "parse_decimal_comma", "safe_ratio", "MONTH_LABELS",
    "MONTH_NUMBERS", "period_from_filename", "period_label", "period_of",
    "blank_key", "sanitize_header", "strip_odd_lot_suffix", "ticker_from_product",
]
