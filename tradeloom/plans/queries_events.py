"""Event-log queries: batch operators and the streaming jobs run over the same table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeloom.operators import events as ev
from tradeloom.operators import state
from tradeloom.plans.catalog import query
from tradeloom.plans.driver_tables import event_log, landed_log, table
from tradeloom.schemas import KAFKA_RECORD, TOPIC_FAMILIES
from tradeloom.session import scratch
from tradeloom.sources.external import RATE_LIMITS
from tradeloom.sources.files import file_event_source, limited_event_source
from tradeloom.streaming import jobs, projection, sinks

_FLAT = """topic, event_id, event_type, event_time, transaction_id, product_type, applicant_country,
  beneficiary_country, currency, CAST(amount AS DOUBLE) AS amount, customer_risk_rating, discrepancy_flag, delay_flag"""
_STATE_COLUMNS = """product_type status issue_date expiry_date currency amount applicant_id beneficiary_id
  applicant_country beneficiary_country goods_category amendment_count document_count processing_days
  discrepancy_flag delay_flag counterparty_relationship_years customer_risk_rating""".split()


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(KAFKA_RECORD).parquet(landed_log(spark, sf_dir))


def _log_stream(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> DataFrame:
    """The log as a stream of its files, shaped like the Kafka topics."""
    return file_event_source(spark, landed_log(spark, sf_dir), files_per_batch)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log for batch queries that read it once: derived where it is read, so no copy is written."""
    return event_log(table(spark, sf_dir, "events"))


def _parsed(spark, sf_dir) -> DataFrame:
    """Every record of the log with its parsed envelope, whatever its topic."""
    return ev.parse_envelope(ev.kafka_metadata_projection(_records(spark, sf_dir)))


def _flat(spark, sf_dir) -> DataFrame:
    return ev.flatten_events(ev.valid_events(_parsed(spark, sf_dir)))


def _checked(spark, sf_dir) -> DataFrame:
    return projection.checked_log(_records(spark, sf_dir))


def _unique(spark, sf_dir) -> DataFrame:
    """First arrival per business transaction: the batch twin of stream dedupe."""
    return ev.first_arrivals(jobs.arriving_transactions(_log(spark, sf_dir)))


# --- Source and envelope ----------------------------------------------------------------------


@query(
    "kafka_event_source",
    "SELECT topic, partition, n AS \"offset\" FROM env WHERE topic <> 'tf.dlq.events'",
    "env",
)
def _(spark, sf_dir):
    return ev.subscribed(_log(spark, sf_dir)).select("topic", "partition", "offset")


_LIMITS = {job: RATE_LIMITS[job] for job in ("kpis", "alerts")}


@query(
    "rate_limit",
    " UNION ALL ".join(
        f"SELECT '{job}' AS job, count(*) AS records, least(count(*), {limit}) AS largest_batch, 0::BIGINT AS over_limit FROM events"
        for job, limit in _LIMITS.items()
    ),
)
def _(spark, sf_dir):
    """Each job reads the whole log, in micro-batches of at most its limit of records; the jobs run side by side."""
    log = _log(spark, sf_dir)

    def started(job: str) -> tuple[StreamingQuery, dict[int, int]]:
        # One number per micro-batch, by its id: a micro-batch that is run again replaces its own.
        sizes: dict[int, int] = {}

        def write(batch: DataFrame, batch_id: int) -> None:
            sizes[batch_id] = batch.count()

        stream = limited_event_source(spark, log, scratch(spark, "limited-log"), _LIMITS[job])
        return sinks.batch_sink(stream, write, scratch(spark, "limited-checkpoint")), sizes

    jobs_run = {job: started(job) for job in _LIMITS}
    for query, _ in jobs_run.values():
        query.awaitTermination()
    found = [
        (job, sum(sizes.values()), max(sizes.values(), default=None), sum(n > _LIMITS[job] for n in sizes.values()))
        for job, (_, sizes) in jobs_run.items()
    ]
    return spark.createDataFrame(found, "job string, records long, largest_batch long, over_limit long")


@query(
    "kafka_metadata_projection",
    """SELECT topic, partition, n AS "offset", record_time AS kafka_timestamp, transaction_id AS kafka_key,
    readable FROM env""",
    "env",
)
def _(spark, sf_dir):
    records = ev.kafka_metadata_projection(_log(spark, sf_dir))
    return records.select(
        "topic",
        "partition",
        "offset",
        "kafka_timestamp",
        "kafka_key",
        (F.col("json_value") != "not json").alias("readable"),
    )


@query(
    "parse_envelope",
    """SELECT n AS "offset", CASE WHEN readable THEN event_id END AS event_id, CASE WHEN readable THEN event_type END AS event_type,
    CASE WHEN readable THEN event_time END AS event_time, CASE WHEN readable THEN transaction_id END AS transaction_id,
    CASE WHEN readable THEN aggregate_id END AS aggregate_id, CASE WHEN readable THEN schema_version END AS schema_version,
    has_payload, CAST(amount AS DOUBLE) AS amount, CAST(rate AS DOUBLE) AS rate FROM env""",
    "env",
)
def _(spark, sf_dir):
    names = "event_id event_type event_time transaction_id aggregate_id schema_version".split()
    return _parsed(spark, sf_dir).select(
        "offset",
        *[F.col(f"event.{n}").alias(n) for n in names],
        F.col("event.payload").isNotNull().alias("has_payload"),
        F.col("event.payload.amount").alias("amount"),
        F.col("event.payload.rate").alias("rate"),
    )


@query(
    "valid_events",
    'SELECT n AS "offset", event_id, transaction_id FROM env WHERE readable AND transaction_id IS NOT NULL',
    "env",
)
def _(spark, sf_dir):
    rows = ev.valid_events(_parsed(spark, sf_dir))
    return rows.select(
        "offset", F.col("event.event_id").alias("event_id"), F.col("event.transaction_id").alias("transaction_id")
    )


@query(
    "flatten_events",
    f"SELECT {_FLAT} FROM env WHERE readable AND transaction_id IS NOT NULL",
    "env",
)
def _(spark, sf_dir):
    return _flat(spark, sf_dir)


@query(
    "business_transactions",
    f"SELECT {_FLAT} FROM env WHERE readable AND transaction_id LIKE 'TF-%' AND amount IS NOT NULL AND currency IS NOT NULL",
    "env",
)
def _(spark, sf_dir):
    return ev.business_transactions(_flat(spark, sf_dir))


@query(
    "event_time_order",
    """SELECT event_id, event_time, transaction_id FROM env WHERE readable AND transaction_id IS NOT NULL
    ORDER BY event_time, event_id""",
    "env",
)
def _(spark, sf_dir):
    return ev.event_time_order(_flat(spark, sf_dir).select("event_id", "event_time", "transaction_id"))


@query(
    "topic_router",
    """SELECT topic, transaction_id AS key, count(*) AS records FROM env
    WHERE readable AND transaction_id IS NOT NULL GROUP BY 1, 2""",
    "env",
)
def _(spark, sf_dir):
    routed = ev.topic_router(_flat(spark, sf_dir).drop("topic"))
    return routed.groupBy("topic", "key").agg(F.count("value").alias("records"))


# --- KPIs and alerts --------------------------------------------------------------------------

_KPI_SQL = """SELECT currency, count(*) AS unique_transactions, CAST(sum(amount) AS DOUBLE) AS total_value,
  CAST(round(CAST(CAST(sum(amount) AS DOUBLE) / count(amount) AS DECIMAL(38,8)), 2) AS DOUBLE) AS avg_transaction_value,
  CAST(sum(CASE WHEN customer_risk_rating = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS high_risk_transactions,
  CAST(sum(CASE WHEN discrepancy_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS discrepancy_transactions,
  CAST(sum(CASE WHEN delay_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS delayed_transactions
  FROM uniq GROUP BY 1"""
_ALERT_SQL = """SELECT transaction_id, product_type, beneficiary_country, currency, CAST(amount AS DOUBLE) AS amount,
  risk_score, 'HIGH' AS risk_level, concat_ws('; ',
    CASE WHEN customer_risk_rating = 'HIGH' THEN 'High-risk customer' END,
    CASE WHEN discrepancy_flag = 1 THEN 'Document discrepancy' END,
    CASE WHEN delay_flag = 1 THEN 'Processing delay' END,
    CASE WHEN amount >= 1000000 THEN 'Large transaction >= 1M' END) AS risk_reason
  FROM (SELECT uniq.*, CASE WHEN customer_risk_rating = 'HIGH' THEN 3 ELSE 0 END
    + CASE WHEN discrepancy_flag = 1 THEN 2 ELSE 0 END + CASE WHEN delay_flag = 1 THEN 2 ELSE 0 END
    + CASE WHEN amount >= 1000000 THEN 2 ELSE 0 END AS risk_score FROM uniq) WHERE risk_score >= 5"""


@query("currency_kpis", _KPI_SQL, "uniq")
def _(spark, sf_dir):
    return ev.currency_kpis(_unique(spark, sf_dir))


@query("high_risk_alerts", _ALERT_SQL, "uniq")
def _(spark, sf_dir):
    return ev.high_risk_alerts(_unique(spark, sf_dir))


@query(
    "ranked_rows",
    """SELECT transaction_id, event_id, CAST(rn AS INTEGER) AS row_rank FROM (SELECT env.*, row_number() OVER
    (PARTITION BY transaction_id ORDER BY event_time DESC, event_id DESC) AS rn FROM env
    WHERE readable AND transaction_id IS NOT NULL) WHERE rn <= 3""",
    "env",
)
def _(spark, sf_dir):
    flat = _flat(spark, sf_dir).select("transaction_id", "event_time", "event_id")
    order = [F.desc("event_time"), F.desc("event_id")]
    return state.ranked_rows(flat, ["transaction_id"], order, 3).drop("event_time")


# --- Keyed projections, batch -----------------------------------------------------------------

_HISTORY_SQL = """SELECT DISTINCT transaction_id || '#' || event_time || '#' || event_id AS row_key, event_type,
  event_time, 'driver' AS source_system, aggregate_type, aggregate_id,
  coalesce(schema_version, '1.0') AS schema_version, null_payload FROM checked WHERE contract_error IS NULL"""
_DOCUMENT_SQL = """SELECT aggregate_id AS document_id, arg_max(transaction_id, (event_time, event_id)) AS transaction_id,
  arg_max(coalesce(document_type, ''), (event_time, event_id)) AS document_type,
  arg_max(event_type, (event_time, event_id)) AS event_type, max(event_time) AS last_event_time
  FROM checked WHERE contract_error IS NULL AND projection_error IS DISTINCT FROM 'null payload'
    AND aggregate_type = 'DOCUMENT' GROUP BY 1"""
_RATE_SQL = """SELECT aggregate_id AS pair, arg_max(base_currency, (event_time, event_id)) AS base_currency,
  arg_max(quote_currency, (event_time, event_id)) AS quote_currency,
  CAST(arg_max(rate, (event_time, event_id)) AS DOUBLE) AS rate, max(event_time) AS last_event_time
  FROM checked WHERE contract_error IS NULL AND projection_error IS NULL AND is_fx GROUP BY 1"""


def _latest(column: str) -> str:
    known = "product_type status currency applicant_country beneficiary_country processing_days discrepancy_flag delay_flag customer_risk_rating amount".split()
    if column not in known:
        kind = "INTEGER" if "count" in column or "years" in column else "VARCHAR"
        return f"CAST(NULL AS {kind}) AS {column}"
    value = f"arg_max({column}, (event_time, event_id)) FILTER ({column} IS NOT NULL)"
    return f"CAST({value} AS DOUBLE) AS {column}" if column == "amount" else f"{value} AS {column}"


_STATE_SQL = f"""SELECT transaction_id, {', '.join(_latest(c) for c in _STATE_COLUMNS)},
  arg_max(event_id, (event_time, event_id)) AS last_event_id,
  arg_max(event_type, (event_time, event_id)) AS last_event_type, max(event_time) AS last_event_time
  FROM checked WHERE contract_error IS NULL AND projection_error IS NULL AND transaction_id <> 'REFERENCE' GROUP BY 1"""
_DEAD_SQL = """SELECT CASE WHEN readable THEN transaction_id ELSE transaction_id END AS key,
  coalesce(contract_error, projection_error) AS reason, count(*) AS records
  FROM checked WHERE coalesce(contract_error, projection_error) IS NOT NULL GROUP BY 1, 2"""


def _dead_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key", "reason").agg(F.count("value").alias("records"))


def _history_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        *[c for c in rows.columns if c != "payload"], (F.col("payload") == "null").alias("null_payload")
    )


@query(
    "envelope_contract",
    """SELECT n AS "offset", contract_error, projection_error FROM checked""",
    "checked",
)
def _(spark, sf_dir):
    return _checked(spark, sf_dir).select("offset", "contract_error", "projection_error")


@query("event_row_key", _HISTORY_SQL, "checked")
def _(spark, sf_dir):
    return _history_rows(state.once_per_key(state.event_history(_checked(spark, sf_dir))))


@query("document_projection", _DOCUMENT_SQL, "checked")
def _(spark, sf_dir):
    return state.document_projection(_checked(spark, sf_dir))


@query("fx_rate_projection", _RATE_SQL, "checked")
def _(spark, sf_dir):
    return state.fx_rate_projection(_checked(spark, sf_dir))


@query("latest_state_by_key", _STATE_SQL, "checked")
def _(spark, sf_dir):
    return state.latest_state_by_key(_checked(spark, sf_dir))


_CELLS = {
    "product_type": "instrument:product_type",
    "status": "instrument:status",
    "currency": "financial:currency",
    "amount": "financial:amount",
    "applicant_country": "geography:applicant_country",
    "beneficiary_country": "geography:beneficiary_country",
    "processing_days": "metrics:processing_days",
    "discrepancy_flag": "metrics:discrepancy_flag",
    "delay_flag": "metrics:delay_flag",
    "customer_risk_rating": "risk:customer_risk_rating",
}


@query(
    "cell_versions",
    "SELECT transaction_id, cell, value, event_id, CAST(rn AS INTEGER) AS row_rank FROM (SELECT *, row_number() OVER "
    "(PARTITION BY transaction_id, cell ORDER BY event_time DESC, event_id DESC) AS rn FROM ("
    + " UNION ALL ".join(
        f"SELECT transaction_id, event_time, event_id, '{cell}' AS cell, CAST({name} AS VARCHAR) AS value "
        "FROM checked WHERE contract_error IS NULL AND projection_error IS NULL AND transaction_id <> 'REFERENCE'"
        for name, cell in _CELLS.items()
    )
    + ") WHERE value IS NOT NULL) WHERE rn <= 3",
    "checked",
)
def _(spark, sf_dir):
    return state.cell_versions(_checked(spark, sf_dir)).select(
        "transaction_id", "cell", "value", "event_id", "row_rank"
    )


# --- Streams ----------------------------------------------------------------------------------


def _projected(spark, sf_dir, tables=projection.ALL_TABLES) -> tuple[str, dict]:
    """Run the state projection to the end of the log; returns its folder and table layouts."""
    root = scratch(spark, "projection")
    stream = _log_stream(spark, sf_dir)
    projection.stream_state_projection(stream, root, f"{root}/checkpoint", tables=tables).awaitTermination()
    return root, projection.table_schemas(_log(spark, sf_dir))


@query(
    "append_stream_sink",
    f"SELECT {_FLAT} FROM env WHERE readable AND transaction_id IS NOT NULL AND topic <> 'tf.dlq.events'",
    "env",
)
def _(spark, sf_dir):
    path = scratch(spark, "events")
    rows = jobs.trade_events(_log_stream(spark, sf_dir))
    sinks.append_stream_sink(rows, path, scratch(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


def _run_kpis(spark, sf_dir) -> DataFrame:
    root = scratch(spark, "kpis")
    log = _log_stream(spark, sf_dir)
    jobs.stream_currency_kpis(log, root, scratch(spark, "checkpoint")).awaitTermination()
    return sinks.read_latest(spark, f"{root}/kpis", ev.currency_kpis(jobs.arriving_transactions(log)).schema)


# Micro-batches that the complete sink writes a version in, at most; their number does not grow with the log.
_VERSIONS = 4


@query("complete_stream_sink", _KPI_SQL, "uniq")
def _(spark, sf_dir):
    """First arrivals as a running aggregate in complete mode, and their KPIs; the newest version has all currencies."""
    files = len(_log(spark, sf_dir).inputFiles())
    log = _log_stream(spark, sf_dir, files_per_batch=-(-files // _VERSIONS))
    first = ev.first_arrivals(jobs.arriving_transactions(log))
    path = scratch(spark, "totals")
    done = sinks.complete_stream_sink(first, path, scratch(spark, "checkpoint"), finish=ev.currency_kpis)
    done.awaitTermination()
    return sinks.read_latest(spark, path, ev.currency_kpis(first).schema)


@query("stream_currency_kpis", _KPI_SQL + " ORDER BY currency", "uniq")
def _(spark, sf_dir):
    return _run_kpis(spark, sf_dir).orderBy("currency")


@query(
    "stream_dedupe",
    "SELECT transaction_id, currency, CAST(amount AS DOUBLE) AS amount FROM uniq",
    "uniq",
)
def _(spark, sf_dir):
    path = scratch(spark, "unique")
    log = _log_stream(spark, sf_dir)
    jobs.stream_dedupe(log, path, scratch(spark, "checkpoint")).awaitTermination()
    unique = jobs.read_first_arrivals(spark, path, jobs.arriving_transactions(log).schema)
    return unique.select("transaction_id", "currency", "amount")


@query("stream_risk_alerts", _ALERT_SQL, "uniq")
def _(spark, sf_dir):
    path = scratch(spark, "alerts")
    log = _log_stream(spark, sf_dir)
    jobs.stream_risk_alerts(log, path, scratch(spark, "checkpoint")).awaitTermination()
    return jobs.read_alerts(spark, path)


@query("state_upsert", _STATE_SQL, "checked")
def _(spark, sf_dir):
    root, schemas = _projected(spark, sf_dir, ["transactions"])
    projection.compact(spark, root, "transactions", schemas["transactions"])
    return state.state_view(
        projection.read_table(spark, root, "transactions", schemas["transactions"])
    )


@query("event_history_sink", _HISTORY_SQL, "checked")
def _(spark, sf_dir):
    root, schemas = _projected(spark, sf_dir, ["history"])
    return _history_rows(projection.read_table(spark, root, "history", schemas["history"]))


@query("dead_letter_sink", _DEAD_SQL, "checked")
def _(spark, sf_dir):
    root, schemas = _projected(spark, sf_dir, [projection.DEAD_LETTERS])
    return _dead_counts(
        projection.read_table(spark, root, projection.DEAD_LETTERS, schemas[projection.DEAD_LETTERS])
    )


@query(
    "stream_state_projection",
    f"""SELECT 'history' AS table_name, count(*) AS records FROM ({_HISTORY_SQL})
    UNION ALL SELECT 'documents', count(*) FROM ({_DOCUMENT_SQL})
    UNION ALL SELECT 'rates', count(*) FROM ({_RATE_SQL})
    UNION ALL SELECT 'transactions', count(*) FROM ({_STATE_SQL})
    UNION ALL SELECT 'dead_letters', CAST(sum(records) AS BIGINT) FROM ({_DEAD_SQL})""",
    "checked",
)
def _(spark, sf_dir):
    root, schemas = _projected(spark, sf_dir)
    out = None
    for name in projection.ALL_TABLES:
        part = projection.read_table(spark, root, name, schemas[name]).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("records")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "at_least_once_commit",
    f"""SELECT count(*) AS first_run, count(*) AS second_run FROM ({_HISTORY_SQL})""",
    "checked",
)
def _(spark, sf_dir):
    root = scratch(spark, "projection")
    schemas = projection.table_schemas(_log(spark, sf_dir))
    counts = []
    for _ in range(2):
        stream = _log_stream(spark, sf_dir)
        projection.stream_state_projection(
            stream, root, f"{root}/checkpoint", tables=["history"]
        ).awaitTermination()
        # Counted here, before the second run could add anything.
        counts.append(projection.read_table(spark, root, "history", schemas["history"]).count())
    return spark.createDataFrame([tuple(counts)], "first_run long, second_run long")


@query(
    "poison_isolation",
    """SELECT count(*) FILTER (coalesce(contract_error, projection_error) IS NULL) AS stored,
    count(*) FILTER (coalesce(contract_error, projection_error) IS NOT NULL) AS isolated FROM checked""",
    "checked",
)
def _(spark, sf_dir):
    """Every record ends up stored or isolated; none stops the stream."""
    root, schemas = _projected(spark, sf_dir, ["history", projection.DEAD_LETTERS])
    dead = projection.read_table(spark, root, projection.DEAD_LETTERS, schemas[projection.DEAD_LETTERS])
    history = projection.read_table(spark, root, "history", schemas["history"])
    both = dead.agg(
        F.count(F.lit(1)).alias("isolated"), F.count_if(F.col("reason").startswith("missing ")).alias("unkeyed")
    ).withColumn("one", F.lit(1))
    kept = history.agg(F.count(F.lit(1)).alias("in_history")).withColumn("one", F.lit(1))
    # Records with a bad payload are in the history and among the dead letters.
    return both.join(kept, "one").select(
        (F.col("in_history") - F.col("isolated") + F.col("unkeyed")).alias("stored"), "isolated"
    )
