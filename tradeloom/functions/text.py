"""Text cleaning for landed strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stripped(c: Column | str) -> Column:
    """Drop carriage returns, then surrounding spaces."""
    return F.trim(F.replace(F.col(c) if isinstance(c, str) else c, F.lit("\r"), F.lit("")))


def clean(c: Column | str) -> Column:
    """``stripped``, with an empty result read as null."""
    return F.nullif(stripped(c), F.lit(""))


def present(c: Column | str) -> Column:
    """True when something other than spaces and carriage returns is there."""
    return clean(c).isNotNull()
