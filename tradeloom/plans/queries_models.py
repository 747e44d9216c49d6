"""Ranks, model inputs, models, metrics, forecasts, risk score and dashboard queries."""

from __future__ import annotations

from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.ml import features, forecast, forests, metrics, risk, sampling
from tradeloom.ml.isolation_forest import fit_isolation_forest
from tradeloom.operators import bi, export, ranking, state
from tradeloom.plans.catalog import query
from tradeloom.plans.driver_tables import model_scores, transactions
from tradeloom.session import scratch
from tradeloom.streaming import rescore

_NUMERIC_TX = ["amount", "amendment_count", "document_count", "counterparty_relationship_years"]


def _feature_rows(spark, sf_dir, *more: str) -> DataFrame:
    return transactions(spark, sf_dir, ["transaction_id", *_NUMERIC_TX, *more])


_OUTPUT_NAMES = "transaction_id product_type beneficiary_country amount customer_risk_rating"


def _outputs(spark, sf_dir, names: str = _OUTPUT_NAMES) -> DataFrame:
    """Transactions with stand-in model outputs, so that what is built on them can be checked.

    The scores are read several times for ranks, so only the named columns, and the joins that they
    need, are part of it.
    """
    k, c = F.col("order_key"), F.col("customer_key")
    kept = names.split()
    rows = transactions(spark, sf_dir, [*kept, "processing_days", "order_key", "customer_key"])
    return rows.select(
        *kept,
        (((k * 7919 + c * 104729) % 10007) / F.lit(10007.0)).alias("anomaly_score"),
        (((k * 31 + c * 17) % 1009) / F.lit(1009.0)).alias("discrepancy_probability"),
        (((k * 13 + c * 7) % 2003) / F.lit(2003.0)).alias("delay_probability"),
        F.col("processing_days").cast("double").alias("predicted_processing_days"),
    )


def _scored(spark, sf_dir) -> DataFrame:
    """Stand-in outputs with anomaly class, risk score and risk level, written once."""
    inputs, path = scratch(spark, "outputs"), scratch(spark, "scored")
    _outputs(spark, sf_dir).write.parquet(inputs)
    classed = ranking.anomaly_cutoff(spark.read.parquet(inputs), "anomaly_score")
    risk.overall_risk_level(risk.overall_risk_score(classed)).write.parquet(path)
    return spark.read.parquet(path)


# --- Ranks and quantiles ----------------------------------------------------------------------


@query(
    "average_percentile_rank",
    """SELECT k, (rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0e0)
    / CAST(count(*) OVER () AS DOUBLE) AS percentile_rank FROM scores""",
    "scores",
)
def _(spark, sf_dir):
    return ranking.average_percentile_rank(model_scores(spark, sf_dir), "p").select("k", "percentile_rank")


@query(
    "anomaly_cutoff",
    """SELECT anomaly_class, count(*) AS transactions, min(anomaly_score) AS lowest_score FROM placed GROUP BY 1""",
    "placed",
)
def _(spark, sf_dir):
    scores = _outputs(spark, sf_dir, "transaction_id").select("anomaly_score")
    classed = ranking.anomaly_cutoff(scores, "anomaly_score")
    return classed.groupBy("anomaly_class").agg(
        F.count(F.lit(1)).alias("transactions"), F.min("anomaly_score").alias("lowest_score")
    )


# --- Features and splits ----------------------------------------------------------------------


@query(
    "feature_frame",
    """SELECT transaction_id, round(ln(1 + greatest(CAST(amount AS DOUBLE), 0)), 9) AS log_amount,
    CAST(amendment_count AS DOUBLE) AS amendment_count, CAST(document_count AS DOUBLE) AS document_count,
    CAST(counterparty_relationship_years AS DOUBLE) AS relationship_years FROM tx""",
    "tx",
)
def _(spark, sf_dir):
    rows = features.feature_frame(_feature_rows(spark, sf_dir), ["transaction_id"])
    # The last bits of a logarithm differ between libraries.
    return rows.withColumn("log_amount", F.round("log_amount", 9))


@query(
    "one_hot",
    " UNION ALL ".join(
        f"SELECT '{c}' AS category, {c} AS level, count(*) AS indicator_sum FROM tx WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in features.CATEGORICAL
    ),
    "tx",
)
def _(spark, sf_dir):
    """Column sums of the encoded vectors, named by category and level."""
    rows = transactions(
        spark, sf_dir, [*_NUMERIC_TX, *features.CATEGORICAL]
    )
    frame = features.feature_frame(rows, categorical=True)
    model = features.one_hot().fit(frame)
    indexer = model.stages[0]
    offset, names = len(features.NUMERIC), []
    for category, levels in zip(features.CATEGORICAL, indexer.labelsArray):
        names += [(offset + i, category, level) for i, level in enumerate(levels)]
        offset += len(levels)
    # Summed as sparse vectors: one number per level, never a row per level and transaction.
    sums = model.transform(frame).select(Summarizer.sum(F.col("features"))).first()[0]
    rows = [(category, level, int(sums[position])) for position, category, level in names if sums[position]]
    return spark.createDataFrame(rows, "category string, level string, indicator_sum long")


_SPLIT_SQL = """SELECT k, y, CASE WHEN rn <= CAST(ceil(round(0.20e0 * n, 6)) AS BIGINT) THEN 'test'
  WHEN rn <= 2 * CAST(ceil(round(0.20e0 * n, 6)) AS BIGINT) THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT k, y, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(k AS VARCHAR) || '#42'), k) AS rn,
        count(*) OVER (PARTITION BY y) AS n FROM scores)"""


@query("stratified_split", _SPLIT_SQL, "scores")
def _(spark, sf_dir):
    rows = model_scores(spark, sf_dir).select("k", "y")
    return sampling.stratified_split(rows, "y", "k", [("test", 0.20), ("validation", 0.20)], "train")


@query(
    "class_weights",
    """SELECT y, count(*) AS class_rows, (SELECT CAST(count(*) AS DOUBLE) FROM scores)
    / ((SELECT CAST(count(DISTINCT y) AS DOUBLE) FROM scores) * count(*)) AS weight FROM scores GROUP BY y""",
    "scores",
)
def _(spark, sf_dir):
    return sampling.class_weights(model_scores(spark, sf_dir), "y")


@query(
    "class_count_gate",
    """SELECT count(*) >= 100 AND count(DISTINCT discrepancy_flag) > 1 AS discrepancy_trains,
    count(*) >= 100 AND count(DISTINCT delay_flag) > 1 AS delay_trains,
    (SELECT count(DISTINCT substr(issue_date, 1, 7)) FROM tx) >= 6 AS forecast_runs FROM tx""",
    "tx",
)
def _(spark, sf_dir):
    rows = transactions(spark, sf_dir, ["discrepancy_flag", "delay_flag", "issue_date"])
    months = forecast.monthly_volume(rows).count()
    gates = (
        sampling.class_count_gate(rows, "discrepancy_flag"),
        sampling.class_count_gate(rows, "delay_flag"),
        months >= forecast.MINIMUM_MONTHS,
    )
    return spark.createDataFrame(
        [gates], "discrepancy_trains boolean, delay_trains boolean, forecast_runs boolean"
    )


# --- Metrics ----------------------------------------------------------------------------------


@query(
    "best_f1_threshold",
    """WITH grid AS (SELECT (20 + 2 * i) / 100.0e0 AS threshold FROM range(31) r(i)),
    counts AS (SELECT threshold, count(*) FILTER (y = 1 AND p >= threshold) AS tp,
      count(*) FILTER (y = 0 AND p >= threshold) AS fp, count(*) FILTER (y = 1 AND p < threshold) AS fn
      FROM grid, scores GROUP BY 1)
    SELECT threshold, tp, fp, fn, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0e0
      ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1
    FROM counts ORDER BY f1 DESC, threshold LIMIT 1""",
    "scores",
)
def _(spark, sf_dir):
    return metrics.best_f1_threshold(model_scores(spark, sf_dir), "y", "p")


@query(
    "classifier_metrics",
    """WITH c AS (SELECT count(*) AS n, count(*) FILTER (y = 1 AND p >= 0.5) AS tp, count(*) FILTER (y = 0 AND p >= 0.5) AS fp,
      count(*) FILTER (y = 1 AND p < 0.5) AS fn, count(*) FILTER (y = 0 AND p < 0.5) AS tn FROM scores)
    SELECT *, CAST(tp + tn AS DOUBLE) / n AS accuracy, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
      CAST(tp AS DOUBLE) / (tp + fn) AS recall, CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) AS f1 FROM c""",
    "scores",
)
def _(spark, sf_dir):
    rows = model_scores(spark, sf_dir).withColumn("hit", (F.col("p") >= 0.5).cast("int"))
    return metrics.classifier_metrics(rows, "y", "hit")


@query(
    "roc_auc",
    """WITH ranked AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0e0 AS r FROM scores),
    s AS (SELECT sum(r) FILTER (y = 1) AS rs, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM ranked)
    SELECT (2 * rs - CAST(pos AS DOUBLE) * (pos + 1)) / (2 * CAST(pos AS DOUBLE) * neg) AS roc_auc FROM s""",
    "scores",
)
def _(spark, sf_dir):
    return metrics.roc_auc(model_scores(spark, sf_dir), "y", "p")


@query(
    "regression_mae",
    "SELECT CAST(sum(abs(processing_days - document_count)) AS DOUBLE) / count(*) AS mae FROM tx",
    "tx",
)
def _(spark, sf_dir):
    rows = transactions(spark, sf_dir, ["processing_days", "document_count"])
    return metrics.regression_mae(rows, "processing_days", "document_count")


@query(
    "probability_bands",
    """SELECT k, CASE WHEN p >= 0.65 THEN 'HIGH' WHEN p >= 0.35 THEN 'MEDIUM' ELSE 'LOW' END AS risk_class FROM scores""",
    "scores",
)
def _(spark, sf_dir):
    return metrics.probability_bands(model_scores(spark, sf_dir), "p").select("k", "risk_class")


# --- Models -----------------------------------------------------------------------------------


def _measured(spark, fitted: forests.Fitted) -> DataFrame:
    names = sorted(fitted.metrics)
    schema = "metric string, value double"
    values = [(n, None if fitted.metrics[n] is None else float(fitted.metrics[n])) for n in names]
    return spark.createDataFrame(values, schema)


@query("isolation_forest_score")
def _(spark, sf_dir):
    rows = features.feature_frame(_feature_rows(spark, sf_dir), ["transaction_id"])
    model = fit_isolation_forest(rows, "transaction_id", features.NUMERIC)
    path = scratch(spark, "anomaly-scores")
    model.transform(rows).select("transaction_id", "anomaly_score").write.parquet(path)
    return ranking.anomaly_cutoff(spark.read.parquet(path), "anomaly_score")


@query("discrepancy_classifier")
def _(spark, sf_dir):
    rows = _feature_rows(spark, sf_dir, "discrepancy_flag")
    return _measured(spark, forests.discrepancy_classifier(rows))


@query("discrepancy_classifier_tuned")
def _(spark, sf_dir):
    rows = _feature_rows(spark, sf_dir, "discrepancy_flag", *features.CATEGORICAL)
    return _measured(spark, forests.discrepancy_classifier_tuned(rows))


@query("delay_classifier")
def _(spark, sf_dir):
    rows = _feature_rows(spark, sf_dir, "delay_flag", *features.CATEGORICAL)
    return _measured(spark, forests.delay_classifier(rows))


@query("delay_regressor")
def _(spark, sf_dir):
    rows = _feature_rows(spark, sf_dir, "delay_flag", "processing_days", *features.CATEGORICAL)
    return _measured(spark, forests.delay_regressor(rows))


@query("periodic_rescore")
def _(spark, sf_dir):
    """The first cycle of the timed stream over the current transactions; results and keys per model."""
    base = scratch(spark, "rescore")
    current = _feature_rows(spark, sf_dir, "discrepancy_flag", "delay_flag", "processing_days", "issue_date")
    path = scratch(spark, "current")
    current.write.parquet(path)
    load = lambda: spark.read.parquet(path)
    stream = rescore.periodic_rescore(spark, load, base, scratch(spark, "rescore-checkpoint"), "1 hour")
    try:
        rescore.await_cycles(stream)
    finally:
        stream.stop()
    return export.read_results(spark, base).groupBy("model_name").agg(
        F.count(F.lit(1)).alias("results"), F.countDistinct("result_key").alias("result_keys")
    )


@query(
    "ml_result_sink",
    """SELECT k || '#stand_in#1.0' AS result_key, p AS probability, 'stand_in' AS model_name,
    0.5e0 AS evaluation_f1 FROM scores""",
    "scores",
)
def _(spark, sf_dir):
    scored = model_scores(spark, sf_dir).withColumnRenamed("p", "probability")
    base = scratch(spark, "results")
    results = export.result_rows(scored, "k", "stand_in", "1.0", ["probability"], {"f1": 0.5})
    export.ml_result_sink(results, base, "stand_in", "1.0")
    return export.read_results(spark, base).select(
        "result_key", "probability", "model_name", "evaluation_f1"
    )


@query(
    "ml_result_mapping",
    """SELECT k || '#document_discrepancy#1.0' AS result_key, 'document_discrepancy' AS model_name, '1.0' AS model_version,
    CAST(NULL AS DOUBLE) AS anomaly_score, CASE WHEN p >= 0.7 THEN 'HIGH' ELSE 'LOW' END AS risk_class,
    CAST(round(CAST(p AS DECIMAL(28,10)), 6) AS DOUBLE) AS probability, CAST(round(CAST(p * 20 AS DECIMAL(28,10)), 2) AS DOUBLE) AS expected_days,
    CAST(NULL AS VARCHAR) AS forecast_month, CAST(NULL AS DOUBLE) AS predicted_transactions, 0.5e0 AS evaluation_f1 FROM scores""",
    "scores",
)
def _(spark, sf_dir):
    """Results through the string store and back."""
    scored = model_scores(spark, sf_dir).select(
        "k",
        F.col("p").alias("probability"),
        (F.col("p") * 20).alias("expected_days"),
        F.when(F.col("p") >= 0.7, "HIGH").otherwise("LOW").alias("risk_class"),
    )
    values = ["probability", "expected_days", "risk_class"]
    results = export.result_rows(scored, "k", "document_discrepancy", "1.0", values, {"f1": 0.5})
    path = scratch(spark, "result-store")
    export.result_store(export.rounded_results(results)).write.parquet(path)
    return state.result_mapping(spark.read.parquet(path)).drop("prediction_timestamp")


# --- Forecast ---------------------------------------------------------------------------------


@query(
    "monthly_volume",
    """WITH m AS (SELECT date_trunc('month', CAST(issue_date AS DATE)) AS month, count(*) AS n FROM tx GROUP BY 1)
    SELECT CAST(CAST(c.month AS DATE) AS VARCHAR) AS month, coalesce(n, 0) AS transactions
    FROM (SELECT unnest(generate_series((SELECT CAST(min(month) AS TIMESTAMP) FROM m),
      (SELECT CAST(max(month) AS TIMESTAMP) FROM m), INTERVAL 1 MONTH)) AS month) c LEFT JOIN m ON m.month = c.month""",
    "tx",
)
def _(spark, sf_dir):
    return forecast.monthly_volume(transactions(spark, sf_dir, ["issue_date"]))


_HOLT_SQL = """WITH RECURSIVE c AS (SELECT product_type, CAST(date_trunc('month', CAST(issue_date AS DATE)) AS TIMESTAMP) AS month,
    count(*) AS n FROM tx GROUP BY 1, 2),
  d AS (SELECT product_type, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month FROM c GROUP BY 1),
  m AS (SELECT d.product_type, CAST(d.month AS DATE) AS month, CAST(coalesce(n, 0) AS DOUBLE) AS y,
    row_number() OVER (PARTITION BY d.product_type ORDER BY d.month) AS i
    FROM d LEFT JOIN c ON c.product_type = d.product_type AND c.month = d.month),
  f AS (SELECT a.product_type, CAST(1 AS BIGINT) AS i, a.y AS level, b.y - a.y AS trend FROM m a
      JOIN m b ON b.product_type = a.product_type AND b.i = 2 WHERE a.i = 1
    UNION ALL SELECT f.product_type, m.i, 0.5e0 * m.y + (1.0e0 - 0.5e0) * (f.level + f.trend),
      0.3e0 * (0.5e0 * m.y + (1.0e0 - 0.5e0) * (f.level + f.trend) - f.level) + (1.0e0 - 0.3e0) * f.trend
      FROM f JOIN m ON m.product_type = f.product_type AND m.i = f.i + 1)
  SELECT f.product_type, strftime(m.month + to_months(CAST(h AS INTEGER)), '%Y-%m') AS forecast_month,
    greatest(0.0e0, CAST(round(CAST(level + h * trend AS DECIMAL(28,8)), 2) AS DOUBLE)) AS predicted_transactions
  FROM f JOIN m ON m.product_type = f.product_type AND m.i = f.i, range(1, 4) r(h)
  WHERE f.i = (SELECT max(i) FROM m WHERE m.product_type = f.product_type)"""


@query("holt_fixed", _HOLT_SQL, "tx")
def _(spark, sf_dir):
    """Fixed parameters, one series per product."""
    rows = transactions(spark, sf_dir, ["product_type", "issue_date"])
    monthly = forecast.monthly_volume(rows, keys=["product_type"])
    return forecast.holt_fixed(monthly, 0.5, 0.3, ["product_type"])


@query("holt_forecast")
def _(spark, sf_dir):
    monthly = forecast.monthly_volume(transactions(spark, sf_dir, ["issue_date"]))
    return forecast.holt_forecast(monthly)


# --- Combined risk and dashboard --------------------------------------------------------------


@query(
    "overall_risk_score",
    "SELECT transaction_id, CAST(overall_risk_score AS DOUBLE) AS overall_risk_score FROM placed",
    "placed",
)
def _(spark, sf_dir):
    rows = _outputs(spark, sf_dir, "transaction_id customer_risk_rating")
    return risk.overall_risk_score(rows).select("transaction_id", "overall_risk_score")


@query(
    "overall_risk_level",
    "SELECT overall_risk_level, count(*) AS transactions FROM levelled GROUP BY 1",
    "levelled",
)
def _(spark, sf_dir):
    rows = _outputs(spark, sf_dir, "transaction_id customer_risk_rating")
    rows = risk.overall_risk_level(risk.overall_risk_score(rows))
    return rows.groupBy("overall_risk_level").agg(F.count(F.lit(1)).alias("transactions"))


_EXPORT_SQL = """SELECT transaction_id, CAST(amount AS DOUBLE) AS amount,
  CAST(round(CAST(anomaly_score AS DECIMAL(28,10)), 6) AS DOUBLE) AS anomaly_score,
  CAST(round(CAST(discrepancy_probability AS DECIMAL(28,10)), 6) AS DOUBLE) AS discrepancy_probability,
  CAST(round(CAST(delay_probability AS DECIMAL(28,10)), 6) AS DOUBLE) AS delay_probability,
  predicted_processing_days, CAST(overall_risk_score AS DOUBLE) AS overall_risk_score, overall_risk_level FROM levelled"""
_EXPORT_COLUMNS = """transaction_id amount anomaly_score discrepancy_probability delay_probability
  predicted_processing_days overall_risk_score overall_risk_level""".split()


@query("scored_export", _EXPORT_SQL, "levelled")
def _(spark, sf_dir):
    rows = _outputs(spark, sf_dir, "transaction_id amount customer_risk_rating")
    return risk.scored_export(rows).select(*_EXPORT_COLUMNS)


@query(
    "model_summary",
    """SELECT count(*) AS dataset_rows, count(*) FILTER (anomaly_class = 'HIGH') AS anomaly_high_count,
    count(*) FILTER (overall_risk_level = 'HIGH') AS high_risk_count,
    count(*) FILTER (overall_risk_level = 'MEDIUM') AS medium_risk_count,
    count(*) FILTER (overall_risk_level = 'LOW') AS low_risk_count,
    CAST(round(CAST(CAST(100 * count(*) FILTER (anomaly_class = 'HIGH') AS DOUBLE) / count(*) AS DECIMAL(38,8)), 2) AS DOUBLE)
      AS anomaly_high_pct FROM levelled""",
    "levelled",
)
def _(spark, sf_dir):
    return risk.model_summary(_scored(spark, sf_dir))


@query(
    "bi_export",
    """SELECT 'scored' AS part, count(*) AS records FROM levelled UNION ALL SELECT 'forecast', 3
    UNION ALL SELECT 'metrics', 1 UNION ALL SELECT 'summary', 7""",
    "levelled",
)
def _(spark, sf_dir):
    path = scratch(spark, "bi-export")
    scored = _scored(spark, sf_dir)
    monthly = forecast.monthly_volume(transactions(spark, sf_dir, ["issue_date"]))
    summary = risk.model_summary(scored)
    export.bi_export(scored, forecast.holt_forecast(monthly), summary, path, export.summary_lines(summary))
    parts = {
        "scored": spark.read.csv(f"{path}/scored", header=True),
        "forecast": spark.read.csv(f"{path}/forecast", header=True),
        "metrics": spark.read.text(f"{path}/metrics"),
        "summary": spark.read.text(f"{path}/summary"),
    }
    out = None
    for name, rows in parts.items():
        part = rows.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("records"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "bi_kpi_cards",
    """SELECT count(*) AS total_transactions, CAST(sum(amount) AS DOUBLE) AS total_exposure,
    count(*) FILTER (overall_risk_level = 'HIGH') AS high_risk_transactions,
    count(*) FILTER (anomaly_class = 'HIGH') AS high_anomalies FROM levelled""",
    "levelled",
)
def _(spark, sf_dir):
    return bi.bi_kpi_cards(_scored(spark, sf_dir))


@query(
    "bi_breakdowns",
    """SELECT 'overall_risk_level' AS dimension, overall_risk_level AS level, 'transaction_count' AS measure,
      CAST(count(*) AS DOUBLE) AS value FROM levelled GROUP BY overall_risk_level
    UNION ALL SELECT 'beneficiary_country', beneficiary_country, 'total_amount', CAST(sum(amount) AS DOUBLE)
      FROM levelled GROUP BY beneficiary_country
    UNION ALL SELECT 'product_type', product_type, 'transaction_count', CAST(count(*) AS DOUBLE)
      FROM levelled GROUP BY product_type
    UNION ALL SELECT 'customer_risk_rating', customer_risk_rating, 'avg_risk_score',
      CAST(sum(overall_risk_score) AS DOUBLE) / count(overall_risk_score) FROM levelled GROUP BY customer_risk_rating""",
    "levelled",
)
def _(spark, sf_dir):
    return bi.bi_breakdowns(_scored(spark, sf_dir))


@query(
    "bi_slice",
    """SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, beneficiary_country,
    CAST(overall_risk_score AS DOUBLE) AS overall_risk_score, overall_risk_level, anomaly_class FROM levelled
    WHERE product_type = 'IMPORT_LC' AND customer_risk_rating = 'HIGH' AND overall_risk_level = 'HIGH'""",
    "levelled",
)
def _(spark, sf_dir):
    chosen = bi.bi_slice(
        _scored(spark, sf_dir),
        product_type="IMPORT_LC",
        customer_risk_rating="HIGH",
        overall_risk_level="HIGH",
    )
    return chosen.select(
        "transaction_id", "amount", "beneficiary_country", "overall_risk_score", "overall_risk_level", "anomaly_class"
    )
