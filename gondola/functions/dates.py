"""Date expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola.settings import WEEKDAY_SLUGS


def as_day(day: Column | dt.date | str) -> Column:
    """A day given as a date, an ISO text or a column (for example a scalar subquery)."""
    return day if isinstance(day, Column) else F.lit(str(day)[:10]).cast("date")


def weekday_slug(day: Column) -> Column:
    """Name of the publisher's weekday slot for a date."""
    return F.element_at(F.array(*map(F.lit, WEEKDAY_SLUGS)), F.weekday(day) + 1)


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text, naive or with a zone, as UTC timestamp; null when unreadable.

    The session time zone is UTC, so naive texts are taken as UTC.
    """
    return F.try_to_timestamp(F.when(F.length(text) > 0, text))


def iso_date(text: Column) -> Column:
    """Strict ``YYYY-MM-DD`` text as date, null otherwise."""
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(text, "yyyy-MM-dd"))
