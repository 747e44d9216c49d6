"""Ratios, rounding and rule helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient in double, null for a zero denominator.

    Sums stay exact decimals or integers up to this one division, so the result does not depend
    on the order in which partitions are merged.
    """
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round2(c: Column) -> Column:
    """Two decimals by way of decimal, half up."""
    return F.round(c.cast("decimal(38,8)"), 2)


def join_reasons(pairs: Sequence[tuple[Column, str]]) -> Column:
    """Texts of the conditions that hold, in order, joined by "; "; empty when none does."""
    return F.concat_ws("; ", *[F.when(condition, F.lit(text)) for condition, text in pairs])


def from_choices(c: Column, choices: Sequence[str]) -> Column:
    """The choice at position ``c`` modulo the number of choices."""
    return F.element_at(F.array(*[F.lit(x) for x in choices]), (c % len(choices) + 1).cast("int"))


def computed_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters must not copy.

    Spark moves a filter below the projection that defines its input and repeats the defining
    expression for every reference. A generator of one row is a step that filters stay above.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))
