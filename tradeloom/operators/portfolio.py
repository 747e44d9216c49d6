"""Portfolio reports over valued transactions.

Every report is one grouped aggregation with map-side partial aggregates, so a hot key costs one
partial row per task. Sums stay decimal or integer; averages divide once at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions import computed_once, ratio, round2
from tradeloom.operators.valuation import fx_valuation
from tradeloom.schemas import SLA_DAYS


def _avg(name: str) -> Column:
    return ratio(F.sum(name), F.count(name))


def _measures() -> dict[str, Column]:
    days = F.col("processing_days")
    return {
        "transaction_count": F.count(F.lit(1)),
        "total_value_cad": F.sum("amount_cad"),
        "exposure_value_cad": F.sum("amount_cad"),
        "avg_transaction_value_cad": _avg("amount_cad"),
        "avg_processing_days": _avg("processing_days"),
        "discrepancy_rate": _avg("discrepancy_flag"),
        "delay_rate": _avg("delay_flag"),
        "document_count": F.sum("document_count"),
        "avg_amendment_count": _avg("amendment_count"),
        # A null number of days is in neither bucket.
        "within_sla": F.count_if(days <= SLA_DAYS),
        "sla_breaches": F.count_if(days > SLA_DAYS),
    }


# Report name -> (grouping keys, measures).
REPORTS: dict[str, tuple[str, str]] = {
    "trade_portfolio": (
        "product_type status applicant_country beneficiary_country",
        "transaction_count total_value_cad avg_transaction_value_cad avg_processing_days "
        "discrepancy_rate delay_rate",
    ),
    "product_performance": (
        "product_type",
        "transaction_count total_value_cad avg_transaction_value_cad avg_processing_days "
        "discrepancy_rate delay_rate",
    ),
    "country_exposure": (
        "beneficiary_country",
        "transaction_count exposure_value_cad avg_transaction_value_cad discrepancy_rate delay_rate",
    ),
    "corridor_performance": (
        "applicant_country beneficiary_country",
        "transaction_count total_value_cad avg_transaction_value_cad avg_processing_days "
        "discrepancy_rate delay_rate",
    ),
    "documentary_operations": (
        "product_type",
        "transaction_count document_count avg_amendment_count discrepancy_rate avg_processing_days",
    ),
    "sla_performance": (
        "product_type",
        "transaction_count within_sla sla_breaches avg_processing_days",
    ),
    "risk_summary": (
        "applicant_country beneficiary_country product_type customer_risk_rating",
        "transaction_count exposure_value_cad discrepancy_rate delay_rate",
    ),
    "annual_growth": (
        "issue_year product_type",
        "transaction_count total_value_cad avg_transaction_value_cad",
    ),
}

# Input columns of each measure, besides the keys.
_MEASURE_INPUTS = {
    "transaction_count": "",
    "total_value_cad": "amount currency",
    "exposure_value_cad": "amount currency",
    "avg_transaction_value_cad": "amount currency",
    "avg_processing_days": "processing_days",
    "discrepancy_rate": "discrepancy_flag",
    "delay_rate": "delay_flag",
    "document_count": "document_count",
    "avg_amendment_count": "amendment_count",
    "within_sla": "processing_days",
    "sla_breaches": "processing_days",
}


def report_inputs(keys: Sequence[str], measures: Sequence[str]) -> list[str]:
    """Transaction columns that a report reads."""
    wanted = ["issue_date" if k == "issue_year" else k for k in keys]
    wanted += ["amount", "currency"]
    for m in measures:
        wanted += _MEASURE_INPUTS[m].split()
    return list(dict.fromkeys(wanted))


def summarise(transactions: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Value the transactions and compute ``measures`` per ``keys``."""
    available = _measures()
    return (
        fx_valuation(transactions)
        .groupBy(*keys)
        .agg(*[available[m].alias(m) for m in measures])
    )


def report(transactions: DataFrame, name: str) -> DataFrame:
    keys, measures = (part.split() for part in REPORTS[name])
    return summarise(transactions, keys, measures)


def portfolio_totals(transactions: DataFrame) -> DataFrame:
    """Totals per product, largest value first."""
    return (
        summarise(
            transactions,
            ["product_type"],
            ["transaction_count", "total_value_cad", "avg_transaction_value_cad"],
        )
        .withColumn("total_value_cad", F.round("total_value_cad", 2))
        .withColumn("avg_transaction_value_cad", round2(F.col("avg_transaction_value_cad")))
        .orderBy(F.desc("total_value_cad"), "product_type")
    )


def top_country_exposure(transactions: DataFrame, limit: int = 10) -> DataFrame:
    """Beneficiary countries with the largest exposure."""
    rows = summarise(
        transactions,
        ["beneficiary_country"],
        ["transaction_count", "exposure_value_cad", "discrepancy_rate"],
    )
    return (
        rows.orderBy(F.desc_nulls_last("exposure_value_cad"), F.asc_nulls_last("beneficiary_country"))
        .limit(limit)
        .select(
            "beneficiary_country",
            "transaction_count",
            F.round("exposure_value_cad", 2).alias("exposure_value_cad"),
            round2(F.col("discrepancy_rate") * 100).alias("discrepancy_rate_pct"),
        )
    )


def busiest_corridors(transactions: DataFrame, limit: int = 10) -> DataFrame:
    """Country pairs with the most transactions."""
    rows = summarise(
        transactions,
        ["applicant_country", "beneficiary_country"],
        ["transaction_count", "total_value_cad", "avg_processing_days"],
    )
    return (
        rows.orderBy(
            F.desc("transaction_count"),
            F.asc_nulls_last("applicant_country"),
            F.asc_nulls_last("beneficiary_country"),
        )
        .limit(limit)
        .select(
            "applicant_country",
            "beneficiary_country",
            "transaction_count",
            F.round("total_value_cad", 2).alias("total_value_cad"),
            round2(F.col("avg_processing_days")).alias("avg_processing_days"),
        )
    )


def sla_rate(transactions: DataFrame) -> DataFrame:
    """Share of transactions inside the service level, lowest first."""
    pct = ratio(F.col("within_sla") * 100, F.col("transaction_count"))
    return (
        report(transactions, "sla_performance")
        .select(
            "product_type",
            "transaction_count",
            "within_sla",
            "sla_breaches",
            round2(pct).alias("within_sla_pct"),
            round2(F.col("avg_processing_days")).alias("avg_processing_days"),
        )
        .orderBy("within_sla_pct", "product_type")
    )


def risk_concentration(transactions: DataFrame) -> DataFrame:
    """Exposure and rates per customer rating and product, largest exposure first."""
    rows = summarise(
        transactions,
        ["customer_risk_rating", "product_type"],
        ["transaction_count", "exposure_value_cad", "discrepancy_rate", "delay_rate"],
    )
    return rows.select(
        "customer_risk_rating",
        "product_type",
        "transaction_count",
        F.round("exposure_value_cad", 2).alias("exposure_value_cad"),
        round2(F.col("discrepancy_rate") * 100).alias("discrepancy_rate_pct"),
        round2(F.col("delay_rate") * 100).alias("delay_rate_pct"),
    ).orderBy(F.desc_nulls_last("exposure_value_cad"), "customer_risk_rating", "product_type")


def annual_trend(transactions: DataFrame) -> DataFrame:
    """Yearly counts and values per product, in year order."""
    return (
        report(transactions, "annual_growth")
        .select(
            "issue_year",
            "product_type",
            "transaction_count",
            F.round("total_value_cad", 2).alias("total_value_cad"),
            round2(F.col("avg_transaction_value_cad")).alias("avg_transaction_value_cad"),
        )
        .orderBy("issue_year", "product_type")
    )


def readable_amounts(lines: DataFrame, value: str = "value") -> DataFrame:
    """Parse transaction JSON lines for the volume report and mark the lines it can use.

    A line counts when all four keys are there and the amount reads as a number. A key that is
    there with a null text is kept, as the text "None"; a null amount is not a number.
    """
    fields = "product_type beneficiary_country currency amount".split()
    parsed = computed_once(
        lines,
        "line",
        F.struct(
            F.from_json(value, ", ".join(f"{f} string" for f in fields)).alias("t"),
            F.json_object_keys(value).alias("found"),
        ),
    ).select("line.t", "line.found")
    number = F.col("t.amount").try_cast("double")
    amount = number.try_cast("decimal(38,8)")
    has_keys = F.size(F.array_intersect("found", F.array(*[F.lit(f) for f in fields]))) == len(fields)
    return parsed.select(
        *[F.coalesce(F.col(f"t.{f}"), F.lit("None")).alias(f) for f in fields[:3]],
        F.round(amount, 2).alias("amount"),
        F.coalesce(has_keys & number.isNotNull(), F.lit(False)).alias("usable"),
    )


def volume_by_product_country_currency(lines: DataFrame, value: str = "value") -> DataFrame:
    """Count and value per product, beneficiary country and original currency."""
    return (
        readable_amounts(lines, value)
        .filter("usable")
        .groupBy("product_type", "beneficiary_country", "currency")
        .agg(F.count(F.lit(1)).alias("transaction_count"), F.sum("amount").alias("total_value"))
    )


def mapper_validation(lines: DataFrame, value: str = "value") -> DataFrame:
    """How many lines the volume report uses and how many it skips."""
    return (
        readable_amounts(lines, value)
        .agg(
            F.count_if("usable").alias("valid_rows"),
            F.count_if(~F.col("usable")).alias("invalid_rows"),
        )
    )
