"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal or scientific notation, or infinity. Guards the cast, which would also
# take Java literals such as "10d" or "0x1p3"; the cast trims by itself.
_NUMBER = (
    r"^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"
)


def to_number(text: Column) -> Column:
    """Text as double; whatever is not a number becomes null."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def direction(delta: Column, flat: float = 0.005) -> Column:
    """``flat`` / ``up`` / ``down`` class of a percentage change, null for null."""
    return (
        F.when(delta.isNull() | F.isnan(delta), None)
        .when(F.abs(delta) < flat, "flat")
        .when(delta > 0, "up")
        .otherwise("down")
    )
