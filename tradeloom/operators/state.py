"""Event-sourced projections: history, current state, documents, rates and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions import int_through_double
from tradeloom.schemas import CELL_VERSIONS, RESULT_CELLS, TRANSACTION_CELLS

REQUIRED = "event_id event_type event_time source aggregate_type aggregate_id transaction_id".split()


def envelope_contract(parsed: DataFrame) -> DataFrame:
    """Add ``contract_error`` and ``projection_error`` to parsed envelopes; null when fine.

    A record that breaks the contract can not be keyed, so it goes to no table. A record with a
    projection error is in the history and in no other table. Both go to the dead letters.
    """
    missing = F.concat_ws(
        ", ", *[F.when(F.col(f"event.{name}").isNull(), F.lit(name)) for name in REQUIRED]
    )
    payload = F.col("event.payload")
    # An explicit null differs from an absent payload; the keys are read only where it matters.
    explicit_null = payload.isNull() & F.coalesce(
        F.array_contains(F.json_object_keys("json_value"), "payload"), F.lit(False)
    )
    is_rate = F.col("event.event_type") == "FX_RATE_UPDATED"
    rate_gap = is_rate & (
        F.col("event.payload.base_currency").isNull()
        | F.col("event.payload.quote_currency").isNull()
        | F.col("event.payload.rate").isNull()
    )
    return parsed.withColumn(
        "contract_error", F.when(missing != "", F.concat(F.lit("missing "), missing))
    ).withColumn(
        "projection_error",
        F.when(F.col("contract_error").isNull() & explicit_null, "null payload").when(
            F.col("contract_error").isNull() & rate_gap, "incomplete rate"
        ),
    )


def event_row_key(events: DataFrame) -> Column:
    """History key: chronological within a transaction."""
    return F.concat_ws("#", "event.transaction_id", "event.event_time", "event.event_id")


def event_history(checked: DataFrame) -> DataFrame:
    """History rows of every event that keeps the contract."""
    return checked.filter("contract_error is null").select(
        event_row_key(checked).alias("row_key"),
        F.col("event.event_type").alias("event_type"),
        F.col("event.event_time").alias("event_time"),
        F.col("event.source").alias("source_system"),
        F.col("event.aggregate_type").alias("aggregate_type"),
        F.col("event.aggregate_id").alias("aggregate_id"),
        F.coalesce("event.schema_version", F.lit("1.0")).alias("schema_version"),
        # The payload text as it came; an absent one reads as an empty object.
        F.coalesce(
            F.get_json_object("json_value", "$.payload"),
            F.when(F.col("projection_error") == "null payload", "null").otherwise("{}"),
        ).alias("payload"),
    )


def once_per_key(history: DataFrame) -> DataFrame:
    """One row per history key: a replayed event writes the key it wrote before."""
    return history.dropDuplicates(["row_key"])


def dead_letters(checked: DataFrame) -> DataFrame:
    """Original key and value of every record that failed, with the reason."""
    reason = F.coalesce("contract_error", "projection_error")
    return checked.filter(reason.isNotNull()).select(
        F.col("kafka_key").alias("key"), F.col("json_value").alias("value"), reason.alias("reason")
    )


def _projectable(checked: DataFrame) -> DataFrame:
    return checked.filter("contract_error is null and projection_error is null")


def _latest(rows: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """Row of the newest event per key, newest by (event_time, event_id)."""
    packed = F.struct(
        F.col("event.event_time").alias("event_time"),
        F.col("event.event_id").alias("event_id"),
        *[c.alias(name) for name, c in values.items()],
    )
    return (
        rows.groupBy(F.col("event.aggregate_id").alias(key))
        .agg(F.max(packed).alias("newest"))
        .select(key, *[F.col(f"newest.{n}") for n in values], F.col("newest.event_time").alias("last_event_time"))
    )


def document_events(checked: DataFrame) -> DataFrame:
    # A bad rate stops an event after its document is stored, so only the payload must be there.
    return checked.filter(
        "contract_error is null and projection_error is distinct from 'null payload' "
        "and event.aggregate_type = 'DOCUMENT'"
    )


def document_projection(checked: DataFrame) -> DataFrame:
    """Newest presentation per document."""
    return _latest(
        document_events(checked),
        "document_id",
        {
            "transaction_id": F.col("event.transaction_id"),
            "document_type": F.coalesce("event.payload.document_type", F.lit("")),
            "event_type": F.col("event.event_type"),
        },
    )


def rate_events(checked: DataFrame) -> DataFrame:
    return _projectable(checked).filter("event.event_type = 'FX_RATE_UPDATED'")


def fx_rate_projection(checked: DataFrame) -> DataFrame:
    """Newest rate per currency pair."""
    return _latest(
        rate_events(checked),
        "pair",
        {
            "base_currency": F.col("event.payload.base_currency"),
            "quote_currency": F.col("event.payload.quote_currency"),
            "rate": F.col("event.payload.rate"),
        },
    )


STATE_COLUMNS = list(TRANSACTION_CELLS)


def state_events(checked: DataFrame) -> DataFrame:
    return _projectable(checked).filter("event.transaction_id <> 'REFERENCE'")


def state_delta(checked: DataFrame) -> DataFrame:
    """State of each transaction as cells (event_time, event_id, value), newest non-null per column.

    ``merge_cells`` folds deltas in any order and any number of times to the same state, so a
    replayed or late batch does no harm. One shuffle serves all columns.
    """
    time, event = F.col("event.event_time"), F.col("event.event_id")

    def cell(value: Column) -> Column:
        return F.when(
            value.isNotNull(),
            F.struct(time.alias("event_time"), event.alias("event_id"), value.alias("value")),
        )

    return (
        state_events(checked)
        .groupBy(F.col("event.transaction_id").alias("transaction_id"))
        .agg(
            *[F.max(cell(F.col(f"event.payload.{c}"))).alias(c) for c in STATE_COLUMNS],
            F.max(cell(F.col("event.event_type"))).alias("last_event_type"),
        )
    )


def merge_cells(deltas: DataFrame) -> DataFrame:
    """Fold deltas of the same layout into one row of cells per transaction."""
    cells = [c for c in deltas.columns if c in (*STATE_COLUMNS, "last_event_type")]
    return deltas.groupBy("transaction_id").agg(*[F.max(c).alias(c) for c in cells])


def state_view(cells: DataFrame) -> DataFrame:
    """Plain values of the cells."""
    return cells.select(
        "transaction_id",
        *[F.col(f"{c}.value").alias(c) for c in STATE_COLUMNS],
        F.col("last_event_type.event_id").alias("last_event_id"),
        F.col("last_event_type.value").alias("last_event_type"),
        F.col("last_event_type.event_time").alias("last_event_time"),
    )


def latest_state_by_key(checked: DataFrame) -> DataFrame:
    """Current state per transaction: per column the newest non-null value."""
    return state_view(state_delta(checked))


def ranked_rows(rows: DataFrame, partition: list[str], order: list[Column], keep: int) -> DataFrame:
    """First ``keep`` rows of each partition in the given total order, with ``row_rank``.

    Spark limits each group on the map side before the shuffle, so a hot group sends at most
    ``keep`` rows per task.
    """
    window = Window.partitionBy(*partition).orderBy(*order)
    return rows.withColumn("row_rank", F.row_number().over(window)).filter(F.col("row_rank") <= keep)


def cell_versions(checked: DataFrame, keep: int = CELL_VERSIONS) -> DataFrame:
    """Newest ``keep`` written values of every cell."""
    cells = F.array(
        *[
            F.struct(F.lit(cell).alias("cell"), F.col(f"event.payload.{name}").cast("string").alias("value"))
            for name, cell in TRANSACTION_CELLS.items()
        ]
    )
    written = (
        state_events(checked)
        .select(
            F.col("event.transaction_id").alias("transaction_id"),
            F.col("event.event_time").alias("event_time"),
            F.col("event.event_id").alias("event_id"),
            F.inline(cells),
        )
        .filter("value is not null")
    )
    return ranked_rows(
        written,
        ["transaction_id", "cell"],
        [F.desc("event_time"), F.desc("event_id")],
        keep,
    )


# --- Wide string store ------------------------------------------------------------------------


def to_string_store(rows: DataFrame, load_source: str | None = None) -> DataFrame:
    """Write typed transactions as string cells; a null value leaves its cell out (null)."""
    cells = [F.col(c).cast("string").alias(cell) for c, cell in TRANSACTION_CELLS.items() if c in rows.columns]
    audit = [F.lit(load_source).alias("audit:load_source")] if load_source else []
    return rows.select(F.col("transaction_id").alias(":key"), *cells, *audit)


_STORE_TYPES = {
    "amount": "decimal(18,2)",
    "amendment_count": "int",
    "document_count": "int",
    "processing_days": "int",
    "discrepancy_flag": "int",
    "delay_flag": "int",
    "anomaly_score": "double",
    "probability": "double",
    "expected_days": "double",
    "predicted_transactions": "double",
}


def hive_typed_mapping(store: DataFrame, cells: dict[str, str] | None = None) -> DataFrame:
    """Typed columns over string cells; text that does not fit its type reads as null."""
    results = cells is not None and "model_name" in cells
    mapping = cells or {k: v for k, v in TRANSACTION_CELLS.items() if k != "counterparty_relationship_years"}
    return store.select(
        F.col(":key").alias("result_key" if results else "transaction_id"),
        *[
            F.col(f"`{cell}`").try_cast(_STORE_TYPES.get(name, "double" if name.startswith("evaluation_") else "string")).alias(name)
            for name, cell in mapping.items()
        ],
    )


def result_mapping(store: DataFrame) -> DataFrame:
    """Typed columns over stored model results, with one number per evaluation cell."""
    measured = [c for c in store.columns if c.startswith("evaluation:")]
    return hive_typed_mapping(store, RESULT_CELLS | {c.replace(":", "_"): c for c in measured})


def current_state_scan(store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed model input rows, and the rows that could not be read.

    A missing number counts as 0 and a missing text as empty; a cell that holds text which is no
    number, the empty text included, takes its whole row out.
    """
    names = {
        "amendment_count": "amendment_count",
        "document_count": "document_count",
        "processing_days": "processing_days",
        "relationship_years": "counterparty_relationship_years",
        "discrepancy_flag": "discrepancy_flag",
        "delay_flag": "delay_flag",
    }

    def cell(name: str) -> Column:
        return F.col(f"`{TRANSACTION_CELLS[name]}`")

    typed = store.select(
        F.col(":key").alias("transaction_id"),
        F.coalesce(cell("amount"), F.lit("0")).try_cast("double").alias("amount"),
        *[
            int_through_double(F.coalesce(cell(source), F.lit("0"))).alias(name)
            for name, source in names.items()
        ],
        F.coalesce(cell("product_type"), F.lit("")).alias("product_type"),
        F.coalesce(cell("issue_date"), F.lit("")).alias("issue_date"),
    )
    numbers = ["amount", *names]
    readable = F.lit(True)
    for name in numbers:
        readable = readable & F.col(name).isNotNull()
    return typed.filter(readable), typed.filter(~readable).select("transaction_id")


def point_lookup(rows: DataFrame, key: str, column: str = "transaction_id") -> DataFrame:
    """Row of one key; the predicate reaches the file scan."""
    return rows.filter(F.col(column) == key)


def prefix_scan(rows: DataFrame, prefix: str, limit: int, column: str = "transaction_id") -> DataFrame:
    """First ``limit`` rows of a key prefix, in key order."""
    return rows.filter(F.col(column).startswith(prefix)).orderBy(column).limit(limit)


def lookup_id_guard(rows: DataFrame, column: str = "transaction_id") -> DataFrame:
    """Rows whose key has only letters, digits, dot, underscore and dash."""
    return rows.filter(F.col(column).rlike("^[A-Za-z0-9._-]+$"))
