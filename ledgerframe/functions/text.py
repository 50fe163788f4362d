"""String expressions for statement keys and headers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values (header sanitising of statement sheets) -------------------
# Space and slash become underscores, parentheses are dropped, and these
# sixteen accented letters become plain ASCII; every other character is kept.
HEADER_REPLACEMENTS = {
    " ": "_", "/": "_", "(": "", ")": "",
    "ã": "a", "ç": "c", "é": "e", "í": "i", "ó": "o", "ú": "u",
    "Ã": "A", "Ç": "C", "É": "E", "Í": "I", "Ó": "O", "Ú": "U",
    "â": "a", "ê": "e", "ô": "o", "á": "a",
}
# Separator between ticker and company name in product descriptions.
PRODUCT_SEPARATOR = " - "
# Odd-lot market suffix on trade codes.
ODD_LOT_SUFFIX = "F"
# ---------------------------------------------------------------------------

# ``translate`` arguments: characters with a replacement first, then the
# characters to delete (``translate`` drops source characters that have no
# counterpart in the replacement string).
_REPLACED = [(a, b) for a, b in HEADER_REPLACEMENTS.items() if b]
_DELETED = [a for a, b in HEADER_REPLACEMENTS.items() if not b]
TRANSLATE_FROM = "".join(a for a, _ in _REPLACED) + "".join(_DELETED)
TRANSLATE_TO = "".join(b for _, b in _REPLACED)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sanitize_header(header: Column | str) -> Column:
    """Header cleaning (I10). ``translate`` deletes source characters that have
    no counterpart, which is how the parentheses are removed."""
    return F.translate(_col(header), TRANSLATE_FROM, TRANSLATE_TO)


def sanitize_header_py(header: str) -> str:
    """Driver-side twin of :func:`sanitize_header` for fixed header lists."""
    return header.translate({ord(a): (b or None) for a, b in HEADER_REPLACEMENTS.items()})


def blank_key(key: Column | str) -> Column:
    """True when a staging key is NULL or only spaces (``trim`` strips spaces only)."""
    key = _col(key)
    return key.isNull() | (F.trim(key.cast("string")) == F.lit(""))


def strip_odd_lot_suffix(code: Column | str) -> Column:
    """Trimmed trade code without one trailing upper-case ``F``."""
    trimmed = F.trim(_col(code).cast("string"))
    return F.when(trimmed.endswith(ODD_LOT_SUFFIX),
                  F.left(trimmed, F.length(trimmed) - 1)).otherwise(trimmed)


def ticker_from_product(product: Column | str) -> Column:
    """Text before the first ``' - '``, trimmed; whole string when absent."""
    return F.trim(F.split_part(_col(product).cast("string"), F.lit(PRODUCT_SEPARATOR), F.lit(1)))
