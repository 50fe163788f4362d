"""Reference-period (``YYYY-MM``) expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# --- fixed values (must equal the statement conventions) -------------------
# Portuguese month word in a statement file name -> month number.
MONTH_NUMBERS = {
    "janeiro": "01", "fevereiro": "02", "marco": "03", "abril": "04",
    "maio": "05", "junho": "06", "julho": "07", "agosto": "08",
    "setembro": "09", "outubro": "10", "novembro": "11", "dezembro": "12",
}
# Month number -> short Portuguese label used in report sections.
MONTH_LABELS = {
    "01": "Jan", "02": "Fev", "03": "Mar", "04": "Abr", "05": "Mai", "06": "Jun",
    "07": "Jul", "08": "Ago", "09": "Set", "10": "Out", "11": "Nov", "12": "Dez",
}
UNKNOWN_MONTH = "00"
# File-name pattern: four digits, a dash, a word, ".xlsx" at the end.  The
# word class is Unicode letters/digits/underscore, so "março" is one word (it
# then maps to "00", because the table key is spelled without the cedilla).
FILENAME_PERIOD_PATTERN = r"(\p{Nd}{4})-([\p{L}\p{N}_]+)\.xlsx$"

# ---------------------------------------------------------------------------


def _filename_pattern(extension: str) -> str:
    return FILENAME_PERIOD_PATTERN.replace(r"\.xlsx$", r"\." + extension + "$")


def _literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def period_of(ts: Column | str) -> Column:
    """``YYYY-MM`` of a date or timestamp.  The value is taken as a date
    first, so a timestamp without time zone never passes through the session
    time zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(ts.cast("date"), "yyyy-MM")


def period_from_filename(name: Column | str, extension: str = "xlsx") -> Column:
    """Reference period from a statement file name.

    ``relatorio-2024-junho.xlsx`` -> ``2024-06``; an unknown month word gives
    month ``00``; a name without the pattern is returned unchanged.  Other
    landings (``csv``) use the same rule with their own extension.
    """
    name = F.col(name) if isinstance(name, str) else name
    pattern = _filename_pattern(extension)
    matched = F.regexp_like(name, F.lit(pattern))
    year = F.regexp_extract(name, pattern, 1)
    word = F.regexp_extract(name, pattern, 2)
    month = F.coalesce(F.try_element_at(_literal_map(MONTH_NUMBERS), word),
                       F.lit(UNKNOWN_MONTH))
    return F.when(matched, F.concat(year, F.lit("-"), month)).otherwise(name)


def period_label(period: Column | str) -> Column:
    """``2024-06`` -> ``Jun/24``; input without exactly one dash is returned as is."""
    period = F.col(period) if isinstance(period, str) else period
    # "exactly one dash" without splitting into an array per row
    one_dash = (F.length(period) - F.length(F.replace(period, F.lit("-"), F.lit("")))) == 1
    month = F.substring_index(period, "-", -1)
    label = F.coalesce(F.try_element_at(_literal_map(MONTH_LABELS), month), month)
    year = F.substring(F.substring_index(period, "-", 1), 3, 2147483647)
    return F.when(one_dash, F.concat(label, F.lit("/"), year)).otherwise(period)


def period_first_day(period: Column | str) -> Column:
    """First day of a ``YYYY-MM`` period; NULL when the period is not a real
    month (``2024-00``, a file name)."""
    period = F.col(period) if isinstance(period, str) else period
    return F.try_to_timestamp(F.concat(period, F.lit("-01")), F.lit("yyyy-MM-dd")).cast("date")


def period_day(period: Column | str, day: int) -> Column:
    """Date of the given day (1-28) inside a period (the rate window ends on
    day 28); NULL for an invalid period."""
    return F.date_add(period_first_day(period), day - 1)
