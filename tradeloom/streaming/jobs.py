"""Streaming jobs over a Kafka-shaped log. Source and sink are handed in."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegerType, StructField, StructType

from tradeloom.functions import ratio, round2
from tradeloom.operators.events import (
    ALERT_COLUMNS,
    ARRIVAL,
    business_transactions,
    currency_kpis,
    flatten_events,
    high_risk_alerts,
    kafka_metadata_projection,
    parse_envelope,
    subscribed,
    valid_events,
)
from tradeloom.schemas import TOPIC_FAMILIES
from tradeloom.streaming.sinks import append_stream_sink, batch_sink, read_version, write_version

# The alert job leaves the reference-rate topic out.
ALERT_FAMILIES = tuple(f for f in TOPIC_FAMILIES if f != "fx")


def parsed_log(log: DataFrame, families=TOPIC_FAMILIES) -> DataFrame:
    """Subscribed records with their parsed envelope."""
    return parse_envelope(kafka_metadata_projection(subscribed(log, families)))


def trade_events(log: DataFrame) -> DataFrame:
    """Flat valid events."""
    return flatten_events(valid_events(parsed_log(log)))


def arriving_transactions(
    log: DataFrame, families=TOPIC_FAMILIES, require_currency: bool = True
) -> DataFrame:
    """Events of business transactions with their place in the log."""
    flat = flatten_events(
        valid_events(parsed_log(log, families), require_event_id=False), with_arrival=True
    )
    return business_transactions(flat, require_currency)


# How the state keeps a row: all its digits, and its times to the microsecond.
_JSON = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def _place_in_log() -> Column:
    """Text that sorts like the columns of ``ARRIVAL``."""
    time = F.lpad(F.coalesce(F.unix_micros("kafka_timestamp"), F.lit(0)).cast("string"), 20, "0")
    rest = [F.lpad(F.col(c).cast("string"), 20, "0") for c in ("partition", "offset")]
    return F.concat_ws("\0", time, "topic", *rest)


def _replace_first(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Keep the first arrival of a key; when it changes, take the old one back and give the new one."""
    held = state.get if state.exists else None
    first = held
    for batch in batches:
        at = batch["place"].idxmin()
        if first is None or batch["place"][at] < first[0]:
            first = (batch["place"][at], batch["packed"][at])
    if first is not None and first != held:
        state.update(first)
        out = [(key[0], first[1], 1)] if held is None else [(key[0], held[1], -1), (key[0], first[1], 1)]
        yield pd.DataFrame(out, columns=["transaction_id", "packed", "change"])


def arrival_changes(rows: DataFrame) -> DataFrame:
    """A stream of rows with their place in the log as changes of the first arrival per transaction: ``change``
    is 1 for a row that is now the first, and -1 for one that no longer is.

    The state store holds one row per transaction, and a micro-batch touches only the transactions in it. The order
    is that of the log, not of the micro-batches, so the changes add up to the same rows however it was cut.
    """
    rest = [c for c in rows.columns if c != "transaction_id"]
    packed = F.to_json(F.struct(*rest), _JSON)
    keyed = rows.select("transaction_id", _place_in_log().alias("place"), packed.alias("packed"))
    changed = keyed.groupBy("transaction_id").applyInPandasWithState(
        _replace_first,
        "transaction_id string, packed string, change int",
        "place string, packed string",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    row = F.from_json("packed", rows.select(rest).schema, _JSON)
    unpacked = changed.withColumn("row", row).select("transaction_id", *[F.col(f"row.{c}") for c in rest], "change")
    return unpacked.select(*rows.columns, "change")


def read_first_arrivals(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One row per transaction out of the changes under ``path``: what was given and not taken back."""
    changes = spark.read.schema(StructType([*schema.fields, StructField("change", IntegerType())])).parquet(path)
    place = ["transaction_id", "topic", "partition", "offset"]
    gone = changes.where("change < 0").select(place)
    return changes.where("change > 0").drop("change").join(gone, place, "left_anti")


def stream_dedupe(
    log: DataFrame,
    path: str,
    checkpoint: str,
    families=TOPIC_FAMILIES,
    require_currency: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """Append the changes of the first arrival of every transaction; read with ``read_first_arrivals``."""
    changes = arrival_changes(arriving_transactions(log, families, require_currency))
    return append_stream_sink(changes, path, checkpoint, interval)


def kpi_sums(changes: DataFrame) -> DataFrame:
    """What the KPIs of a currency are made of; changes add to it or take from it."""

    def total(value: Column) -> Column:
        return F.sum(F.coalesce(value, F.lit(0)) * F.col("change"))

    return changes.groupBy("currency").agg(
        total(F.lit(1)).alias("unique_transactions"),
        total(F.col("amount")).alias("total_value"),
        total(F.col("amount").isNotNull().cast("int")).alias("valued"),
        total((F.col("customer_risk_rating") == "HIGH").cast("int")).alias("high_risk_transactions"),
        total((F.col("discrepancy_flag") == 1).cast("int")).alias("discrepancy_transactions"),
        total((F.col("delay_flag") == 1).cast("int")).alias("delayed_transactions"),
    )


def stream_currency_kpis(
    log: DataFrame, root: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """KPIs per currency over all transactions so far, one version per micro-batch in ``root/kpis``.

    A micro-batch adds its changes to the sums of the version before, so its work does not grow with the
    stream. Run again, it finds that version untouched in the other slot.
    """
    rows = arriving_transactions(log)
    kpis = currency_kpis(rows).schema
    changes = arrival_changes(rows)
    sums = kpi_sums(changes).schema
    whole = {f.name: f.dataType for f in sums if f.name != "currency"}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        total = kpi_sums(batch)
        if batch_id:
            total = total.unionByName(read_version(spark, f"{root}/sums", sums, batch_id - 1))
        total = total.groupBy("currency").agg(*[F.sum(n).cast(kind).alias(n) for n, kind in whole.items()])
        write_version(total.where("unique_transactions > 0"), batch_id, f"{root}/sums")
        now = read_version(spark, f"{root}/sums", sums, batch_id)
        average = round2(ratio(F.col("total_value"), F.col("valued"))).alias("avg_transaction_value")
        given = now.select("*", average)
        write_version(given.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kpis]), batch_id, f"{root}/kpis")

    return batch_sink(changes, write, checkpoint, interval)


def stream_risk_alerts(
    log: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Append an alert when a transaction at HIGH level is first seen (``change`` 1), and take it back (-1) when an
    earlier arrival turns up in its place."""
    changes = arrival_changes(arriving_transactions(log, ALERT_FAMILIES, require_currency=False))
    return append_stream_sink(high_risk_alerts(changes, ["event_id", "change"]), path, checkpoint, interval)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Alerts that stand: given and not taken back."""
    alerts = spark.read.parquet(path)
    standing = alerts.groupBy(*ALERT_COLUMNS, "event_id").agg(F.sum("change").alias("n")).where("n > 0")
    return standing.select(*ALERT_COLUMNS)
