"""Batch sinks: exports, landing zones, model results and published reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.operators.portfolio import report
from tradeloom.operators.state import to_string_store
from tradeloom.schemas import RESULT_CELLS, RESULT_TOPICS

ZONES = {
    "raw": ("transactions", "customers", "counterparties", "events"),
    "curated": (),
    "exports": (),
}

# Reports that the BI tool reads.
PUBLISHED = (
    "trade_portfolio",
    "corridor_performance",
    "documentary_operations",
    "sla_performance",
    "risk_summary",
)


def tsv_export(volume: DataFrame, path: str) -> None:
    """Volume report as tab-separated text, totals with two decimals."""
    # A decimal prints all its digits, where a number format would go through double.
    volume.withColumn("total_value", F.col("total_value").cast("decimal(38,2)").cast("string")).write.mode(
        "overwrite"
    ).csv(path, sep="\t")


def zone_path(base: str, zone: str, dataset: str) -> str:
    allowed = ZONES[zone]
    if allowed and dataset not in allowed:
        raise ValueError(f"no dataset {dataset} in zone {zone}")
    return f"{base}/{zone}/{dataset}"


def zone_landing(rows: DataFrame, base: str, zone: str, dataset: str) -> str:
    """Put a dataset into its zone, replacing what was there."""
    path = zone_path(base, zone, dataset)
    rows.write.mode("overwrite").parquet(path)
    return path


def full_refresh(rows: DataFrame, path: str) -> DataFrame:
    """Replace a stored table by ``rows`` and return it."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)


def publish_bi_tables(transactions: DataFrame, base: str) -> dict[str, str]:
    """Write the published reports; returns their paths."""
    paths = {}
    for name in PUBLISHED:
        paths[name] = f"{base}/{name}"
        report(transactions, name).write.mode("overwrite").parquet(paths[name])
    return paths


def result_rows(
    scored: DataFrame, key: str, model: str, version: str, values: list[str], metrics: Mapping = {}
) -> DataFrame:
    """Prediction rows keyed id#model#version, with evaluation columns and a UTC time stamp."""
    return scored.select(
        F.concat_ws("#", F.col(key).cast("string"), F.lit(model), F.lit(version)).alias("result_key"),
        F.lit(model).alias("model_name"),
        F.lit(version).alias("model_version"),
        *[F.col(v) for v in values],
        *[F.lit(v).cast("double").alias(f"evaluation_{n}") for n, v in metrics.items()],
        F.current_timestamp().alias("prediction_timestamp"),
    )


# Digits that stored scores, probabilities and days keep (fixed values).
RESULT_DIGITS = {"anomaly_score": 6, "probability": 6, "expected_days": 2}


def rounded_results(results: DataFrame) -> DataFrame:
    """Result rows with their numbers rounded, half up."""
    kept = {c: d for c, d in RESULT_DIGITS.items() if c in results.columns}
    return results.withColumns(
        {c: F.round(F.col(c).cast("decimal(28,10)"), d).cast("double") for c, d in kept.items()}
    )


def result_store(results: DataFrame) -> DataFrame:
    """Result rows as string cells under their key; see ``state.result_mapping`` for the way back."""
    names = {"risk_class": "anomaly_class"} if "anomaly_class" in results.columns else {}
    cells = {cell: names.get(name, name) for name, cell in RESULT_CELLS.items()}
    cells |= {
        f"evaluation:{c.removeprefix('evaluation_')}": c for c in results.columns if c.startswith("evaluation_")
    }
    return results.select(
        F.col("result_key").alias(":key"),
        *[
            (F.col(c) if c in results.columns else F.lit(None)).cast("string").alias(cell)
            for cell, c in cells.items()
        ],
    )


def ml_result_sink(results: DataFrame, base: str, model: str, version: str) -> str:
    """Replace the stored results of one model version."""
    path = f"{base}/model_name={model}/model_version={version}"
    results.drop("model_name", "model_version").write.mode("overwrite").parquet(path)
    return path


def result_messages(results: DataFrame, key: str, model: str) -> DataFrame:
    """Topic records of results, ready for a Kafka writer."""
    return results.select(
        F.lit(RESULT_TOPICS[model]).alias("topic"),
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct("*")).alias("value"),
    )


def kafka_publish(records: DataFrame, servers: str) -> None:
    """Send records (topic, key, value) to their topics. Needs the Spark Kafka package."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def bi_export(
    scored: DataFrame, forecast: DataFrame, metrics: DataFrame, path: str, summary: DataFrame | None = None
) -> None:
    """Scored rows and forecast as CSV, metrics as JSON, and the summary as text lines."""
    scored.write.mode("overwrite").csv(f"{path}/scored", header=True)
    forecast.write.mode("overwrite").csv(f"{path}/forecast", header=True)
    metrics.write.mode("overwrite").json(f"{path}/metrics")
    if summary is not None:
        summary.write.mode("overwrite").text(f"{path}/summary")


def summary_lines(metrics: DataFrame, title: str = "Model summary") -> DataFrame:
    """A text line per metric of a one-row relation."""
    names = metrics.columns
    lines = F.array(
        F.lit(title),
        *[
            F.concat(F.lit(f"{n}: "), F.coalesce(F.col(n).cast("string"), F.lit("n/a")))
            for n in names
        ],
    )
    return metrics.select(F.explode(lines).alias("value"))


def bulk_load(transactions: DataFrame, path: str, load_source: str) -> DataFrame:
    """Store transactions as string cells under their key; a row without a key stops the load."""
    if not transactions.filter(F.col("transaction_id").isNull()).isEmpty():
        raise ValueError("a transaction is missing transaction_id")
    store = to_string_store(transactions, load_source)
    # Sorted files make key lookups and prefix scans skip row groups.
    store.repartitionByRange(":key").sortWithinPartitions(":key").write.mode("overwrite").parquet(path)
    return store.sparkSession.read.parquet(path)


def read_results(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.option("basePath", base).option("mergeSchema", "true").parquet(base)
