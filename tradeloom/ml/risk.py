"""Combined risk score, its levels and the summaries made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions import ratio, round2
from tradeloom.operators.ranking import average_percentile_rank

# Weights of anomaly percentile, discrepancy, delay and customer rating; level borders (fixed values).
WEIGHTS = {"anomaly": 0.25, "discrepancy": 0.30, "delay": 0.35, "customer": 0.10}
HIGH_FROM, MEDIUM_FROM = 65, 40


def overall_risk_score(rows: DataFrame) -> DataFrame:
    """Add ``overall_risk_score`` (0 to 100, two decimals) from the three model outputs and the
    customer rating; an unknown rating counts as MEDIUM."""
    ranked = average_percentile_rank(rows, "anomaly_score", "anomaly_percentile")
    rating = F.col("customer_risk_rating")
    customer = F.when(rating == "LOW", 0.0).when(rating == "HIGH", 1.0).otherwise(0.5)
    score = (
        WEIGHTS["anomaly"] * F.col("anomaly_percentile")
        + WEIGHTS["discrepancy"] * F.col("discrepancy_probability")
        + WEIGHTS["delay"] * F.col("delay_probability")
        + WEIGHTS["customer"] * customer
    )
    return ranked.withColumn("overall_risk_score", round2(score * 100)).drop("anomaly_percentile")


def overall_risk_level(rows: DataFrame) -> DataFrame:
    """Add ``overall_risk_level``, cut on the rounded score."""
    score = F.col("overall_risk_score")
    return rows.withColumn(
        "overall_risk_level",
        F.when(score >= HIGH_FROM, "HIGH").when(score >= MEDIUM_FROM, "MEDIUM").otherwise("LOW"),
    )


def scored_export(rows: DataFrame) -> DataFrame:
    """Rows for the BI tool: model outputs rounded, then combined score and level."""
    levelled = overall_risk_level(overall_risk_score(rows))
    digits = {
        "anomaly_score": 6,
        "discrepancy_probability": 6,
        "delay_probability": 6,
        "predicted_processing_days": 2,
    }
    return levelled.withColumns(
        {c: F.round(F.col(c).cast("decimal(28,10)"), d) for c, d in digits.items() if c in rows.columns}
    )


def model_summary(scored: DataFrame) -> DataFrame:
    """Rows, HIGH anomalies and their share, and rows per risk level, in one pass."""
    counted = scored.agg(
        F.count(F.lit(1)).alias("dataset_rows"),
        F.count_if(F.col("anomaly_class") == "HIGH").alias("anomaly_high_count"),
        *[
            F.count_if(F.col("overall_risk_level") == level.upper()).alias(f"{level}_risk_count")
            for level in ("high", "medium", "low")
        ],
    )
    pct = round2(ratio(F.col("anomaly_high_count") * 100, F.col("dataset_rows")))
    return counted.withColumn("anomaly_high_pct", pct)
