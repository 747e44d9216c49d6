"""Exact ranks and quantiles over all rows without a single-partition sort.

Rows are counted per distinct value, the distinct values are cut into ordered buckets, and each
bucket is summed on its own. Where the bucket borders lie affects only the balance, never the
result.
"""

from __future__ import annotations

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sums_below(
    values: DataFrame,
    order: str,
    columns: list[str],
    edges_from: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Add ``<column>_below``, the sum of the column over all rows with a smaller ``order``, and
    ``<column>_all``, its sum over all rows.

    ``values`` has one row per distinct non-null ``order``. Bucket borders are quantiles of
    ``edges_from`` (``values`` itself by default), which is only scanned. There are as many buckets as
    the session has shuffle partitions, unless told otherwise. The window over the bucket totals sees
    one row per bucket; the window inside a bucket sees its distinct values.
    """
    buckets = buckets or max(2, int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    source = values if edges_from is None else edges_from
    edges = QuantileDiscretizer(
        numBuckets=buckets, inputCol="edge_value", outputCol="bucket", relativeError=0.5 / buckets
    ).fit(source.select(F.col(order).cast("double").alias("edge_value")).filter("edge_value is not null"))
    cut = (
        edges.transform(values.withColumn("edge_value", F.col(order).cast("double")))
        .withColumn("bucket", F.col("bucket").cast("int"))
        .drop("edge_value")
    )
    every = Window.orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        cut.groupBy("bucket")
        .agg(*[F.sum(c).alias(f"total_{i}") for i, c in enumerate(columns)])
        .select(
            "bucket",
            *[
                F.coalesce(F.sum(f"total_{i}").over(earlier), F.lit(0)).alias(f"base_{i}")
                for i in range(len(columns))
            ],
            *[F.sum(f"total_{i}").over(every).alias(f"all_{i}") for i in range(len(columns))],
        )
    )
    inside = (
        Window.partitionBy("bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per bucket, so its size is bounded by the number of buckets.
    return cut.join(F.broadcast(bases), "bucket").select(
        *values.columns,
        *[
            (F.col(f"base_{i}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{c}_below")
            for i, c in enumerate(columns)
        ],
        *[F.col(f"all_{i}").alias(f"{c}_all") for i, c in enumerate(columns)],
    )


def _tie_counts(rows: DataFrame, score: str) -> DataFrame | None:
    """Rows per distinct score with the rows below; None when there is no score at all."""
    scored = rows.select(score).filter(F.col(score).isNotNull())
    if scored.isEmpty():
        return None
    counts = scored.groupBy(score).agg(F.count(F.lit(1)).alias("ties"))
    return sums_below(counts, score, ["ties"], edges_from=scored)


def average_percentile_rank(rows: DataFrame, score: str, output: str = "percentile_rank") -> DataFrame:
    """Add the average rank of ``score`` among its ties, divided by the number of rows.

    A null score has a null rank and does not count.
    """
    placed = _tie_counts(rows, score)
    if placed is None:
        return rows.withColumn(output, F.lit(None).cast("double"))
    rank = F.col("ties_below") + (F.col("ties") + 1) / F.lit(2.0)
    ranked = placed.select(score, (rank / F.col("ties_all").cast("double")).alias(output))
    # Rows without a score have nothing to join and would all meet under one key.
    scored = rows.filter(F.col(score).isNotNull()).join(ranked, score).select(*rows.columns, output)
    return scored.unionByName(
        rows.filter(F.col(score).isNull()).withColumn(output, F.lit(None).cast("double"))
    )


def exact_quantile(rows: DataFrame, score: str, q: float) -> float | None:
    """Quantile with linear interpolation at position q * (n - 1)."""
    placed = _tie_counts(rows, score)
    if placed is None:
        return None
    position = F.lit(q) * (F.col("ties_all") - 1)
    low = F.floor(position)
    high = F.least(low + 1, F.col("ties_all") - 1)

    def at(rank) -> F.Column:
        inside = (F.col("ties_below") <= rank) & (F.col("ties_below") + F.col("ties") > rank)
        return F.max(F.when(inside, F.col(score).cast("double")))

    found = placed.agg(
        at(low).alias("low"), at(high).alias("high"), F.max(position - low).alias("part")
    ).first()
    return found["low"] + (found["high"] - found["low"]) * found["part"]


def anomaly_cutoff(rows: DataFrame, score: str, q: float = 0.95) -> DataFrame:
    """Add ``anomaly_class``: HIGH at or above the quantile, NORMAL below."""
    cutoff = exact_quantile(rows, score, q)
    return rows.withColumn(
        "anomaly_class", F.when(F.col(score) >= F.lit(cutoff), "HIGH").otherwise("NORMAL")
    )
