"""Literal lookup relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tradeloom.schemas import RETAIL_LOOKUPS


def inline_values(spark: SparkSession, column: str, values: Sequence[str]) -> DataFrame:
    """One-column relation of the given values."""
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def retail_lookups(spark: SparkSession) -> dict[str, DataFrame]:
    """The lookup relations a retail load starts from."""
    return {c: inline_values(spark, c, values) for c, values in RETAIL_LOOKUPS.items()}
