"""Numeric expressions with explicit NULL / ANSI behaviour."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even_int(x: Column | str) -> Column:
    """Double -> int rounding half to even (1.5 -> 2, 2.5 -> 2), as statement
    quantities are cast; a plain Spark cast would truncate."""
    return F.rint(_col(x).cast("double")).cast("int")


# A number as the statement loader's parser accepts it: optional spaces and
# sign, digits with an optional decimal point and exponent, or infinity.
# (A plain cast would also take Java float suffixes such as "12d" and the
# text "NaN", which that parser rejects.)
NUMBER_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def parse_decimal_comma(text: Column | str) -> Column:
    """Text with a decimal comma -> double; NULL when it does not parse as a
    number (an overflowing exponent does not parse either)."""
    t = F.replace(_col(text).cast("string"), F.lit(","), F.lit("."))
    value = t.try_cast("double")
    finite_or_inf = (F.abs(value) < F.lit(float("inf"))) | t.rlike("(?i)inf")
    return F.when(t.rlike(NUMBER_TEXT) & finite_or_inf, value)


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / nullif(den, 0)``: NULL instead of an ANSI division error."""
    return F.try_divide(num, F.nullif(den, F.lit(0)))
