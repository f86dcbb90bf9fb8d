"""Numbers and dates written the Argentine way: ``$12.149``, ``+2,39%``, ``21 jul 2026``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MISSING = "—"
# Month abbreviations.
_MONTHS = ("ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic")


def _swap_separators(text: Column) -> Column:
    return F.translate(text, ",.", ".,")


def _or_missing(value: Column, text: Column) -> Column:
    return F.when(value.isNull(), _MISSING).otherwise(text)


def numero(value: Column, decimals: int = 1) -> Column:
    return _or_missing(value, _swap_separators(F.format_number(value, decimals)))


def ars(value: Column, decimals: int = 0) -> Column:
    # The currency sign stands before the minus sign.
    text = F.concat(F.lit("$"), _swap_separators(F.format_number(value, decimals)))
    return _or_missing(value, text)


def pct(value: Column, decimals: int = 2, signed: bool = True) -> Column:
    # Percentages carry no thousands separator.
    digits = F.translate(F.format_number(value, decimals), ".,", ",")
    sign = F.when(F.lit(signed) & ~digits.startswith("-"), "+").otherwise("")
    return _or_missing(value, F.concat(sign, digits, F.lit("%")))


def count(value: Column) -> Column:
    return _or_missing(value, _swap_separators(F.format_number(value.cast("long"), 0)))


def fecha(value: Column, with_year: bool = True) -> Column:
    month = F.element_at(F.array(*map(F.lit, _MONTHS)), F.month(value))
    parts = [F.dayofmonth(value).cast("string"), month]
    if with_year:
        parts.append(F.year(value).cast("string"))
    return _or_missing(value, F.concat_ws(" ", *parts))
