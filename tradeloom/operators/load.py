"""The retail load: staged tables are checked, typed and published together, or not at all.

Every load writes a version folder of its own. Readers see the version that the newest mark names, so tables
appear together when the mark is written, and a load that a check stops, or that dies, changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.operators import quality

# Staged table -> its typed load, in load order; dimensions come before the lines that refer to them.
TYPED = {
    "Products": quality.typed_products,
    "Stores": quality.typed_stores,
    "Promotions": quality.typed_promotions,
    "RetailEvents": quality.typed_retail_events,
}
DIMENSIONS = {"product_id": "Products", "store_id": "Stores", "promotion_id": "Promotions"}
MARKS = "version string"


def retail_load(
    staged: Mapping[str, DataFrame],
    base: str,
    others: Mapping[str, DataFrame] | None = None,
    expected: Mapping[str, tuple[int, int]] | None = None,
    widths: Mapping[str, int] | None = None,
) -> str:
    """Load the four ``staged`` tables and ``others``, which need no checks, and publish them; returns the version.

    Raises ``LoadRejected`` at the first check that fails: invalid staged rows, table by table; then, on what
    was written, the ``expected`` counts and the references of the sale lines.
    """
    spark = next(iter(staged.values())).sparkSession
    version = f"{datetime.now(UTC):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    stored = {}

    def store(name: str, rows: DataFrame) -> None:
        path = f"{base}/versions/{version}/{name}"
        rows.write.parquet(path)
        stored[name] = spark.read.schema(rows.schema).parquet(path)

    for name, typed in TYPED.items():
        store(name, typed(quality.fail_fast_gate(staged[name], name), widths))
    for name, rows in (others or {}).items():
        store(name, rows)
    if expected:
        quality.require_expected_counts(quality.table_row_counts(stored), expected)
    quality.require_no_orphans(stored["RetailEvents"], {key: stored[name] for key, name in DIMENSIONS.items()})
    mark = spark.createDataFrame([(version,)], MARKS)
    mark.coalesce(1).write.mode("append").parquet(f"{base}/published")
    return version


def published_version(spark: SparkSession, base: str) -> str | None:
    """The newest published version; None before the first."""
    try:
        marks = spark.read.schema(MARKS).parquet(f"{base}/published")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return marks.agg(F.max("version")).first()[0]


def published_table(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """A table of the newest published version."""
    version = published_version(spark, base)
    return None if version is None else spark.read.parquet(f"{base}/versions/{version}/{name}")
