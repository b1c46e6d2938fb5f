"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


EXACT = 9e15  # doubles below it have room for a fraction or at least the last whole digit


def round_stable(value: Column | str, digits: int) -> Column:
    """Round half up by one formula that every engine evaluates alike (no negative zero).

    NaN, infinities and values too large to have the digits stay as they are.
    """
    c = (F.col(value) if isinstance(value, str) else value).cast("double")
    scale = float(10**digits)
    rounded = F.floor(c * F.lit(scale) + F.lit(0.500001)) / F.lit(scale)
    return F.when(F.abs(c) < F.lit(EXACT / scale), rounded).otherwise(c)


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, null where ``bottom`` is zero or null."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def to_number(text: Column | str) -> Column:
    """Parse a text as a number, null for anything else; NaN and infinities count as missing.

    A digit followed by the Java literal suffix d or f is not a number in a data file.
    """
    c = F.col(text) if isinstance(text, str) else text
    return known(F.when(~c.rlike(r"(?i)[0-9.][df]\s*$"), c).try_cast("double"))


def known(number: Column | str) -> Column:
    """The number as a double, null where it is not finite."""
    c = (F.col(number) if isinstance(number, str) else number).cast("double")
    return F.when(F.abs(c) < F.lit(float("inf")), c)
