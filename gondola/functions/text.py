"""Text expressions: trimming, placeholders, accent- and case-insensitive tests."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola.settings import BLANK_KEYS, FOOTER_PREFIX, TEXT_PLACEHOLDERS

# Spark's trim() removes spaces only; these are all characters Unicode calls white space.
_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_FOLDED = "UNICODE_CI_AI"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_WHITESPACE))


def not_placeholder(trimmed: Column, placeholders: Iterable[str] = TEXT_PLACEHOLDERS) -> Column:
    """Trimmed text, null where it is one of the placeholders."""
    return F.when(~F.lower(trimmed).isin(*placeholders), trimmed)


def is_footer_key(key: Column) -> Column:
    """True for blank keys and for the publisher's footer sentence (accents ignored).

    Ids are short, so the length test spares nearly every row the collated comparison.
    """
    blank = key.isNull() | F.lower(strip(key)).isin(*BLANK_KEYS)
    footer = (F.length(key) >= len(FOOTER_PREFIX)) & F.startswith(
        F.collate(strip(key), _FOLDED), F.collate(F.lit(FOOTER_PREFIX), _FOLDED)
    )
    return blank | footer


def contains_folded(text: Column, needles: Iterable[str]) -> Column:
    """Does the text hold one of the needles, whatever its case and accents?"""
    haystack = F.collate(F.coalesce(text, F.lit("")), _FOLDED)
    tests = [F.contains(haystack, F.collate(F.lit(needle), _FOLDED)) for needle in needles]
    return reduce(or_, tests, F.lit(False))


def contains_ignore_case(text: Column, needle: Column | str) -> Column:
    """Literal (not regex) substring test; null text never matches."""
    needle = F.lit(needle) if isinstance(needle, str) else needle
    return F.coalesce(F.contains(F.lower(text), F.lower(needle)), F.lit(False))
