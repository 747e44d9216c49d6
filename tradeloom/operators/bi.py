"""Dashboard aggregates over scored transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions import ratio


def bi_kpi_cards(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count("transaction_id").alias("total_transactions"),
        F.sum("amount").alias("total_exposure"),
        F.count_if(F.col("overall_risk_level") == "HIGH").alias("high_risk_transactions"),
        F.count_if(F.col("anomaly_class") == "HIGH").alias("high_anomalies"),
    )


# Dashboard dimension -> measure shown for it.
BREAKDOWNS = {
    "overall_risk_level": "transaction_count",
    "beneficiary_country": "total_amount",
    "product_type": "transaction_count",
    "customer_risk_rating": "avg_risk_score",
}


def bi_breakdowns(scored: DataFrame) -> DataFrame:
    """(dimension, level, measure, value) of all four charts from one grouping-sets pass."""
    dims = list(BREAKDOWNS)
    grouped = scored.groupingSets([[F.col(d)] for d in dims], *[F.col(d) for d in dims]).agg(
        F.grouping_id().alias("gid"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        ratio(F.sum("overall_risk_score"), F.count("overall_risk_score")).alias("avg_risk_score"),
    )
    # The grouping id has a bit set for every dimension that is folded away.
    full = (1 << len(dims)) - 1
    gids = {full - (1 << (len(dims) - 1 - i)): d for i, d in enumerate(dims)}

    def pick(options: dict) -> F.Column:
        out = None
        for gid, value in options.items():
            out = F.when(F.col("gid") == gid, value) if out is None else out.when(F.col("gid") == gid, value)
        return out

    return grouped.select(
        pick({g: F.lit(d) for g, d in gids.items()}).alias("dimension"),
        pick({g: F.col(d) for g, d in gids.items()}).alias("level"),
        pick({g: F.lit(BREAKDOWNS[d]) for g, d in gids.items()}).alias("measure"),
        pick({g: F.col(BREAKDOWNS[d]).cast("double") for g, d in gids.items()}).alias("value"),
    )


def bi_slice(
    scored: DataFrame,
    product_type: str | None = None,
    beneficiary_country: str | None = None,
    customer_risk_rating: str | None = None,
    overall_risk_level: str | None = None,
) -> DataFrame:
    """Rows that match every slicer that is set."""
    chosen = {
        "product_type": product_type,
        "beneficiary_country": beneficiary_country,
        "customer_risk_rating": customer_risk_rating,
        "overall_risk_level": overall_risk_level,
    }
    for column, value in chosen.items():
        if value is not None:
            scored = scored.filter(F.col(column) == value)
    return scored
