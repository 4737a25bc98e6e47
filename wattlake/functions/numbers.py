"""Numeric expressions that never raise on dirty values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def to_double(value: Column) -> Column:
    """A number from anything; what is none, NaN included, is null."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def to_int(value: Column) -> Column:
    """Whole number from text such as ``2018`` or ``2018.0``; null when it is neither."""
    return value.try_cast("double").try_cast("int")


def to_long(value: Column) -> Column:
    """As ``to_int`` for counts of any size."""
    return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))


def total(value: Column) -> Column:
    """Sum of doubles, 0 over an all-null or empty group."""
    return F.coalesce(F.sum(value), F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 when the whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def whole_year_text(year: Column) -> Column:
    return F.round(to_double(year)).try_cast("int").cast("string")
