"""Valuation of transactions in one currency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.schemas import CAD_RATES, RATE


def rate_to_cad(currency) -> F.Column:
    """Fixed CAD rate of a currency column; null for a currency without one."""
    rate = None
    for code, value in CAD_RATES.items():
        branch = F.lit(value).cast(RATE)
        rate = F.when(currency == code, branch) if rate is None else rate.when(currency == code, branch)
    return rate


def fx_valuation(transactions: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """Add issue year, CAD rate and CAD amount.

    The fixed rates are a folded expression, so the valuation adds no join to the plan. A ``rates``
    relation (currency, exchange_rate_to_cad) replaces them by a left join. A transaction in a
    currency without a rate keeps its row and has a null CAD amount.
    """
    if rates is None:
        valued = transactions.withColumn("exchange_rate_to_cad", rate_to_cad(F.col("currency")))
    else:
        valued = transactions.join(
            rates.select("currency", F.col("exchange_rate_to_cad").cast(RATE)), "currency", "left"
        )
    if "issue_date" in transactions.columns:
        valued = valued.withColumn("issue_year", F.substring("issue_date", 1, 4))
    return valued.withColumn("amount_cad", F.col("amount") * F.col("exchange_rate_to_cad"))
