"""Event envelopes: routing, parsing, validation, KPIs and risk rules.

The functions take batch and streaming frames alike; a stream differs from a batch only in its
source, its sink and the way it removes duplicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions import computed_once, join_reasons, ratio, round2
from tradeloom.schemas import (
    DEAD_LETTER_TOPIC,
    ENVELOPE,
    LARGE_AMOUNT,
    ROUTE_PREFIXES,
    topic_of,
    topic_pattern,
)


def route_topic(event_type: Column) -> Column:
    """Topic of an event type by its prefix; the dead-letter topic when no prefix fits."""
    topic = None
    for family, prefixes in ROUTE_PREFIXES.items():
        for prefix in prefixes:
            condition, target = event_type.startswith(prefix), F.lit(topic_of(family))
            topic = F.when(condition, target) if topic is None else topic.when(condition, target)
    return topic.otherwise(DEAD_LETTER_TOPIC)


def topic_router(events: DataFrame) -> DataFrame:
    """Producer records of flat or nested envelopes: topic, key (transaction id) and JSON value."""
    return events.select(
        route_topic(F.col("event_type")).alias("topic"),
        F.col("transaction_id").alias("key"),
        F.to_json(F.struct("*")).alias("value"),
    )


def subscribed(log: DataFrame, families=None) -> DataFrame:
    """Records of the topics that a job subscribes to."""
    pattern = topic_pattern() if families is None else topic_pattern(families)
    return log.filter(F.col("topic").rlike(f"^(?:{pattern})$"))


def kafka_metadata_projection(log: DataFrame) -> DataFrame:
    """Record position and text of key and value."""
    return log.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("json_value"),
    )


def parse_envelope(records: DataFrame) -> DataFrame:
    """Add ``event``: the envelope read from ``json_value``. Unreadable text gives null fields."""
    return computed_once(records, "event", F.from_json("json_value", ENVELOPE))


def valid_events(parsed: DataFrame, require_event_id: bool = True) -> DataFrame:
    """Rows that carry a transaction id and, unless waived, an event id."""
    keep = F.col("event.transaction_id").isNotNull()
    if require_event_id:
        keep = keep & F.col("event.event_id").isNotNull()
    return parsed.filter(keep)


_FLAT_PAYLOAD = (
    "product_type applicant_country beneficiary_country currency amount customer_risk_rating "
    "discrepancy_flag delay_flag"
).split()


# Order of arrival: the time a record entered the log, then its place there.
ARRIVAL = ["kafka_timestamp", "topic", "partition", "offset"]


def flatten_events(parsed: DataFrame, with_arrival: bool = False) -> DataFrame:
    """Flat business columns of parsed envelopes; on demand with the columns of ``ARRIVAL``."""
    return parsed.select(
        *(ARRIVAL if with_arrival else ["topic"]),
        *[
            F.col(f"event.{name}").alias(name)
            for name in ("event_id", "event_type", "event_time", "transaction_id")
        ],
        *[F.col(f"event.payload.{name}").alias(name) for name in _FLAT_PAYLOAD],
    )


def business_transactions(flat: DataFrame, require_currency: bool = True) -> DataFrame:
    """Events of real transactions: reference-data events and events without amount drop out."""
    keep = F.col("transaction_id").startswith("TF-") & F.col("amount").isNotNull()
    if require_currency:
        keep = keep & F.col("currency").isNotNull()
    return flat.filter(keep)


def first_arrivals(flat: DataFrame, key: str = "transaction_id") -> DataFrame:
    """The event per key that arrived first, by ``ARRIVAL``: stream dedupe of a batch.

    An aggregate, not a window: each task passes on one row per key, however hot the key is. Folding
    folded parts gives the same rows, so a stream can fold its micro-batches one by one.
    """
    rest = [c for c in flat.columns if c != key]
    packed = F.struct(*ARRIVAL, *[c for c in rest if c not in ARRIVAL])
    return (
        flat.groupBy(key).agg(F.min(packed).alias("first")).select(key, *[F.col(f"first.{c}") for c in rest])
    )


def currency_kpis(unique: DataFrame) -> DataFrame:
    """Per original currency: transactions, value and counts of risky ones."""

    def hits(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    return unique.groupBy("currency").agg(
        F.count(F.lit(1)).alias("unique_transactions"),
        F.sum("amount").alias("total_value"),
        round2(ratio(F.sum("amount"), F.count("amount"))).alias("avg_transaction_value"),
        hits(F.col("customer_risk_rating") == "HIGH").alias("high_risk_transactions"),
        hits(F.col("discrepancy_flag") == 1).alias("discrepancy_transactions"),
        hits(F.col("delay_flag") == 1).alias("delayed_transactions"),
    )


def risk_rules() -> list[tuple[Column, int, str]]:
    """Condition, points and reason text of each rule (fixed values)."""
    return [
        (F.col("customer_risk_rating") == "HIGH", 3, "High-risk customer"),
        (F.col("discrepancy_flag") == 1, 2, "Document discrepancy"),
        (F.col("delay_flag") == 1, 2, "Processing delay"),
        (F.col("amount") >= LARGE_AMOUNT, 2, "Large transaction >= 1M"),
    ]


def risk_score(rows: DataFrame) -> DataFrame:
    """Add ``risk_score``: the points of all rules that hold; a null input scores nothing."""
    points = F.lit(0)
    for condition, weight, _ in risk_rules():
        points = points + F.when(condition, weight).otherwise(0)
    return rows.withColumn("risk_score", points)


def risk_level(rows: DataFrame) -> DataFrame:
    score = F.col("risk_score")
    return rows.withColumn(
        "risk_level", F.when(score >= 5, "HIGH").when(score >= 3, "MEDIUM").otherwise("LOW")
    )


def risk_reason(rows: DataFrame) -> DataFrame:
    return rows.withColumn("risk_reason", join_reasons([(c, text) for c, _, text in risk_rules()]))


ALERT_COLUMNS = (
    "transaction_id product_type beneficiary_country currency amount risk_score risk_level risk_reason"
).split()


def high_risk_alerts(unique: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Alert rows of the transactions at HIGH level, with the columns ``keep`` as they are."""
    scored = risk_level(risk_score(unique)).filter("risk_level = 'HIGH'")
    return risk_reason(scored).select(*ALERT_COLUMNS, *keep)


def event_time_order(flat: DataFrame) -> DataFrame:
    """Events in time order, ties by event id (a range-partitioned sort)."""
    return flat.orderBy("event_time", "event_id")
