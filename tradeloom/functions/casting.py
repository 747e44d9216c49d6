"""Casts that give null instead of raising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.functions.text import stripped


def as_int(c: Column | str) -> Column:
    return stripped(c).try_cast("int")


def as_smallint(c: Column | str) -> Column:
    return stripped(c).try_cast("smallint")


def as_decimal(c: Column | str, precision: int = 12, scale: int = 2) -> Column:
    return stripped(c).try_cast(f"decimal({precision},{scale})")


def as_date(c: Column | str) -> Column:
    return stripped(c).try_cast("date")


def as_seconds(c: Column | str) -> Column:
    """Timestamp cut to whole seconds."""
    return F.date_trunc("second", stripped(c).try_cast("timestamp"))


def int_through_double(c: Column) -> Column:
    """Whole part of a number text: "3.7" gives 3, an unreadable text gives null."""
    number = c.try_cast("double")
    return F.when(number.between(-(2.0**31), 2.0**31 - 1), number.cast("int"))
