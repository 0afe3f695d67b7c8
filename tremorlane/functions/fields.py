"""Defaults and conversions for loosely typed event fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that a JVM double parser accepts but a plain decimal reader does
# not: a type suffix (1d, 2.5f) and hexadecimal floats (0x1p3).
_JVM_ONLY_NUMBER = r"[0-9.][dDfF]|[xX]"


def number(text: Column) -> Column:
    """Text as double; NULL where it is not a number."""
    return F.when(~text.rlike(_JVM_ONLY_NUMBER), text.try_cast("double"))


def number_or_zero(text: Column) -> Column:
    """0.0 for an absent, null or empty value; NULL for text that is no number."""
    return F.when(text.isNull() | (text == ""), F.lit(0.0)).otherwise(number(text))


def coordinate(coordinates: Column, position: int) -> Column:
    """One element of a coordinate list; 0.0 where the list is too short or absent."""
    return F.when(
        F.size(coordinates) > position, number(F.get(coordinates, F.lit(position)))
    ).otherwise(F.lit(0.0))


def first_filled(preferred: Column, fallback: Column) -> Column:
    """`preferred` unless it is absent or empty, then `fallback`, then ''."""
    return F.coalesce(F.nullif(preferred, F.lit("")), fallback, F.lit(""))
