"""Retail summaries over typed sale lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def retail_transaction_summary(events: DataFrame) -> DataFrame:
    """Per transaction and store. Payment and loyalty are the alphabetically last of the lines."""
    return events.groupBy("transaction_id", "store_id").agg(
        F.min("event_timestamp").alias("transaction_timestamp"),
        F.count(F.lit(1)).alias("product_line_count"),
        F.sum(F.col("quantity").cast("long")).alias("total_quantity"),
        F.sum("final_price").alias("transaction_value"),
        F.max("payment_type").alias("payment_type"),
        F.max("loyalty_flag").alias("loyalty_flag"),
    )


def store_sales_summary(events: DataFrame) -> DataFrame:
    """Per store: lines, distinct transactions, units and sales.

    Lines are folded per (store, transaction) first; the second step then counts rows, so a store
    with a large share of all lines is spread over many tasks until it is small.
    """
    store = ["store_id", "store_city", "province", "store_region"]
    per_transaction = events.groupBy(*store, "transaction_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("quantity").cast("long")).alias("units"),
        F.sum("final_price").alias("sales"),
    )
    return per_transaction.groupBy(*store).agg(
        F.sum("lines").alias("product_sale_events"),
        F.count("transaction_id").alias("transaction_count"),
        F.sum("units").alias("units_sold"),
        F.sum("sales").alias("total_sales"),
    )


def retail_totals(events: DataFrame) -> DataFrame:
    """Totals over all lines, with the distinct transactions counted by a fold per transaction."""
    per_transaction = events.groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("event_timestamp").alias("first_at"),
        F.max("event_timestamp").alias("last_at"),
        F.sum("final_price").alias("sales"),
    )
    return per_transaction.agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("product_sale_events"),
        F.count("transaction_id").alias("transactions"),
        F.min("first_at").alias("first_event"),
        F.max("last_at").alias("last_event"),
        F.sum("sales").alias("total_sales"),
    )


def first_events(events: DataFrame, limit: int = 5) -> DataFrame:
    """Earliest lines, ties by event id and then by the remaining columns."""
    rest = [c for c in events.columns if c not in ("event_timestamp", "event_id")]
    return events.orderBy("event_timestamp", "event_id", *rest).limit(limit)
