"""Portfolio, valuation, lookup and file queries over transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.operators import export, portfolio, quality, state
from tradeloom.operators.events import risk_level, risk_reason, risk_score
from tradeloom.operators.valuation import fx_valuation
from tradeloom.plans.catalog import query
from tradeloom.plans.driver_tables import transactions
from tradeloom.schemas import TRANSACTION
from tradeloom.session import scratch
from tradeloom.sources import files

_TX = ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c == "amount" else c for c in TRANSACTION.fieldNames()
)
_AVG_VALUE = "CAST(sum(amount_cad) AS DOUBLE) / nullif(count(amount_cad), 0)"
_SUM_VALUE = "CAST(sum(amount_cad) AS DOUBLE)"


def _avg(c: str) -> str:
    return f"CAST(sum({c}) AS DOUBLE) / nullif(count({c}), 0)"


_MEASURES = {
    "transaction_count": "count(*)",
    "total_value_cad": _SUM_VALUE,
    "exposure_value_cad": _SUM_VALUE,
    "avg_transaction_value_cad": _AVG_VALUE,
    "avg_processing_days": _avg("processing_days"),
    "discrepancy_rate": _avg("discrepancy_flag"),
    "delay_rate": _avg("delay_flag"),
    "document_count": "CAST(sum(document_count) AS BIGINT)",
    "avg_amendment_count": _avg("amendment_count"),
    "within_sla": "CAST(sum(CASE WHEN processing_days <= 10 THEN 1 ELSE 0 END) AS BIGINT)",
    "sla_breaches": "CAST(sum(CASE WHEN processing_days > 10 THEN 1 ELSE 0 END) AS BIGINT)",
}


def _report_sql(name: str) -> str:
    keys, measures = (part.split() for part in portfolio.REPORTS[name])
    items = ", ".join([*keys, *[f"{_MEASURES[m]} AS {m}" for m in measures]])
    return f"SELECT {items} FROM valued GROUP BY {', '.join(keys)}"


def _report_rows(spark, sf_dir, keys: str, measures: str) -> DataFrame:
    return transactions(spark, sf_dir, portfolio.report_inputs(keys.split(), measures.split()))


def _register_report(name: str) -> None:
    keys, measures = portfolio.REPORTS[name]

    @query(name, _report_sql(name), "valued")
    def _(spark, sf_dir):
        return portfolio.report(_report_rows(spark, sf_dir, keys, measures), name)


for _name in portfolio.REPORTS:
    _register_report(_name)


def _r2(expression: str) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,8)), 2) AS DOUBLE)"


@query(
    "portfolio_totals",
    f"""SELECT product_type, count(*) AS transaction_count,
    CAST(round(sum(amount_cad), 2) AS DOUBLE) AS total_value_cad,
    {_r2(_AVG_VALUE)} AS avg_transaction_value_cad
    FROM valued GROUP BY product_type ORDER BY 3 DESC, 1""",
    "valued",
)
def portfolio_totals(spark, sf_dir):
    return portfolio.portfolio_totals(
        transactions(spark, sf_dir, ["product_type", "currency", "amount"])
    )


@query(
    "top_country_exposure",
    f"""SELECT beneficiary_country, count(*) AS transaction_count,
    CAST(round(sum(amount_cad), 2) AS DOUBLE) AS exposure_value_cad,
    {_r2(_avg('discrepancy_flag') + ' * 100')} AS discrepancy_rate_pct
    FROM valued GROUP BY 1 ORDER BY sum(amount_cad) DESC NULLS LAST, 1 ASC NULLS LAST LIMIT 10""",
    "valued",
)
def _(spark, sf_dir):
    rows = _report_rows(spark, sf_dir, "beneficiary_country", "exposure_value_cad discrepancy_rate")
    return portfolio.top_country_exposure(rows)


@query(
    "busiest_corridors",
    f"""SELECT applicant_country, beneficiary_country, count(*) AS transaction_count,
    CAST(round(sum(amount_cad), 2) AS DOUBLE) AS total_value_cad,
    {_r2(_avg('processing_days'))} AS avg_processing_days
    FROM valued GROUP BY 1, 2 ORDER BY 3 DESC, 1 ASC NULLS LAST, 2 ASC NULLS LAST LIMIT 10""",
    "valued",
)
def _(spark, sf_dir):
    keys = "applicant_country beneficiary_country"
    return portfolio.busiest_corridors(
        _report_rows(spark, sf_dir, keys, "total_value_cad avg_processing_days")
    )


@query(
    "sla_rate",
    f"""SELECT product_type, count(*) AS transaction_count, {_MEASURES['within_sla']} AS within_sla,
    {_MEASURES['sla_breaches']} AS sla_breaches,
    {_r2("CAST(100 * sum(CASE WHEN processing_days <= 10 THEN 1 ELSE 0 END) AS DOUBLE) / count(*)")} AS within_sla_pct,
    {_r2(_avg('processing_days'))} AS avg_processing_days
    FROM valued GROUP BY 1 ORDER BY 5, 1""",
    "valued",
)
def _(spark, sf_dir):
    rows = transactions(spark, sf_dir, ["product_type", "currency", "amount", "processing_days"])
    return portfolio.sla_rate(rows)


@query(
    "risk_concentration",
    f"""SELECT customer_risk_rating, product_type, count(*) AS transaction_count,
    CAST(round(sum(amount_cad), 2) AS DOUBLE) AS exposure_value_cad,
    {_r2(_avg('discrepancy_flag') + ' * 100')} AS discrepancy_rate_pct,
    {_r2(_avg('delay_flag') + ' * 100')} AS delay_rate_pct
    FROM valued GROUP BY 1, 2 ORDER BY 4 DESC, 1, 2""",
    "valued",
)
def _(spark, sf_dir):
    keys = "customer_risk_rating product_type"
    return portfolio.risk_concentration(
        _report_rows(spark, sf_dir, keys, "exposure_value_cad discrepancy_rate delay_rate")
    )


@query(
    "annual_trend",
    f"""SELECT issue_year, product_type, count(*) AS transaction_count,
    CAST(round(sum(amount_cad), 2) AS DOUBLE) AS total_value_cad,
    {_r2(_AVG_VALUE)} AS avg_transaction_value_cad
    FROM valued GROUP BY 1, 2 ORDER BY 1, 2""",
    "valued",
)
def _(spark, sf_dir):
    rows = transactions(spark, sf_dir, ["issue_date", "product_type", "currency", "amount"])
    return portfolio.annual_trend(rows)


@query(
    "fx_valuation",
    """SELECT transaction_id, currency, issue_year, CAST(rate AS DOUBLE) AS exchange_rate_to_cad,
    CAST(amount AS DOUBLE) AS amount, CAST(amount_cad AS DOUBLE) AS amount_cad FROM valued""",
    "valued",
)
def _(spark, sf_dir):
    rows = transactions(spark, sf_dir, ["transaction_id", "currency", "issue_date", "amount"])
    return fx_valuation(rows).select(
        "transaction_id", "currency", "issue_year", "exchange_rate_to_cad", "amount", "amount_cad"
    )


# --- Rules on transactions --------------------------------------------------------------------

_SCORE = """CASE WHEN customer_risk_rating = 'HIGH' THEN 3 ELSE 0 END
  + CASE WHEN discrepancy_flag = 1 THEN 2 ELSE 0 END + CASE WHEN delay_flag = 1 THEN 2 ELSE 0 END
  + CASE WHEN amount >= 1000000 THEN 2 ELSE 0 END"""
_LEVEL = f"CASE WHEN {_SCORE} >= 5 THEN 'HIGH' WHEN {_SCORE} >= 3 THEN 'MEDIUM' ELSE 'LOW' END"
_REASON = """concat_ws('; ', CASE WHEN customer_risk_rating = 'HIGH' THEN 'High-risk customer' END,
  CASE WHEN discrepancy_flag = 1 THEN 'Document discrepancy' END,
  CASE WHEN delay_flag = 1 THEN 'Processing delay' END,
  CASE WHEN amount >= 1000000 THEN 'Large transaction >= 1M' END)"""


def _rule_rows(spark, sf_dir):
    return transactions(
        spark,
        sf_dir,
        ["transaction_id", "amount", "customer_risk_rating", "discrepancy_flag", "delay_flag"],
    )


@query("risk_score", f"SELECT transaction_id, {_SCORE} AS risk_score FROM tx", "tx")
def _(spark, sf_dir):
    return risk_score(_rule_rows(spark, sf_dir)).select("transaction_id", "risk_score")


@query("risk_level", f"SELECT {_LEVEL} AS risk_level, count(*) AS transactions FROM tx GROUP BY 1", "tx")
def _(spark, sf_dir):
    levelled = risk_level(risk_score(_rule_rows(spark, sf_dir)))
    return levelled.groupBy("risk_level").agg(F.count(F.lit(1)).alias("transactions"))


@query("risk_reason", f"SELECT transaction_id, {_REASON} AS risk_reason FROM tx", "tx")
def _(spark, sf_dir):
    return risk_reason(_rule_rows(spark, sf_dir)).select("transaction_id", "risk_reason")


# --- JSON lines for the volume report ---------------------------------------------------------


def _volume_lines(spark, sf_dir) -> DataFrame:
    """Transaction JSON lines; some lack the product, some have it null, some amounts are no number."""
    rows = transactions(
        spark,
        sf_dir,
        ["order_key", "product_type", "beneficiary_country", "currency", "amount"],
    )
    k = F.col("order_key")
    body = F.to_json(
        F.struct(
            F.when(k % 59 != 0, F.col("product_type")).alias("product_type"),
            F.coalesce("beneficiary_country", F.lit("NONE")).alias("beneficiary_country"),
            "currency",
            F.when(k % 53 == 0, F.lit("n/a")).otherwise(F.col("amount").cast("string")).alias("amount"),
        )
    )
    null_product = (k % 59 == 0) & (k % 2 == 0)
    return rows.select(
        F.when(null_product, F.concat(F.lit('{"product_type":null,'), F.substr(body, F.lit(2))))
        .otherwise(body)
        .alias("value")
    )


_VOLUME = """SELECT CASE WHEN order_key % 59 = 0 THEN 'None' ELSE product_type END AS product_type,
  coalesce(beneficiary_country, 'NONE') AS beneficiary_country, currency, count(*) AS transaction_count,
  {total} AS total_value
  FROM tx WHERE order_key % 53 <> 0 AND (order_key % 59 <> 0 OR order_key % 2 = 0) GROUP BY 1, 2, 3"""


@query(
    "volume_by_product_country_currency",
    _VOLUME.format(total="CAST(sum(amount) AS DOUBLE)"),
    "tx",
)
def _(spark, sf_dir):
    return portfolio.volume_by_product_country_currency(_volume_lines(spark, sf_dir))


@query("tsv_export", _VOLUME.format(total="CAST(sum(amount) AS VARCHAR)"), "tx")
def _(spark, sf_dir):
    path = scratch(spark, "tsv")
    export.tsv_export(
        portfolio.volume_by_product_country_currency(_volume_lines(spark, sf_dir)), path
    )
    return spark.read.csv(
        path,
        sep="\t",
        schema="product_type string, beneficiary_country string, currency string, "
        "transaction_count long, total_value string",
    )


@query(
    "mapper_validation",
    """SELECT count(*) FILTER (order_key % 53 <> 0 AND (order_key % 59 <> 0 OR order_key % 2 = 0)) AS valid_rows,
    count(*) FILTER (order_key % 53 = 0 OR (order_key % 59 = 0 AND order_key % 2 <> 0)) AS invalid_rows FROM tx""",
    "tx",
)
def _(spark, sf_dir):
    return portfolio.mapper_validation(_volume_lines(spark, sf_dir))


# --- Files ------------------------------------------------------------------------------------

DOCUMENT_ROWS = 500


def _land_json_arrays(rows: DataFrame, path: str) -> None:
    """Write JSON array documents of up to ``DOCUMENT_ROWS`` rows, one document per file."""
    row = F.monotonically_increasing_id()
    (
        rows.select(
            # Partition number and place in the partition: consecutive rows share a document.
            F.floor(row / DOCUMENT_ROWS).alias("document"),
            F.to_json(F.struct("*")).alias("record"),
        )
        .groupBy("document")
        .agg(
            F.concat(F.lit("["), F.concat_ws(",\n", F.collect_list("record")), F.lit("]")).alias("value")
        )
        .write.partitionBy("document")
        .text(path)
    )


@query("json_array_scan", f"SELECT {_TX} FROM tx", "tx")
def _(spark, sf_dir):
    path = scratch(spark, "json-arrays")
    _land_json_arrays(transactions(spark, sf_dir), path)
    return files.json_array_scan(spark, path)


@query("jsonl_scan", f"SELECT {_TX} FROM tx", "tx")
def _(spark, sf_dir):
    path = scratch(spark, "json-lines")
    transactions(spark, sf_dir).write.json(path)
    return files.jsonl_scan(spark, path)


@query(
    "json_to_jsonl",
    """SELECT product_type, count(*) AS records, CAST(sum(amount) AS DOUBLE) AS amount,
    (SELECT count(*) FROM tx) AS reported FROM tx GROUP BY 1""",
    "tx",
)
def _(spark, sf_dir):
    source, target = scratch(spark, "json-arrays"), scratch(spark, "json-lines")
    _land_json_arrays(transactions(spark, sf_dir, ["transaction_id", "product_type", "amount"]), source)
    written = files.json_to_jsonl(spark, source, target)
    return (
        files.jsonl_scan(spark, target)
        .groupBy("product_type")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("amount").alias("amount"))
        .withColumn("reported", F.lit(written).cast("long"))
    )


# --- String store -----------------------------------------------------------------------------


def _string_store(spark, sf_dir) -> DataFrame:
    """String cells with some unreadable, missing and fractional numbers."""
    store = state.to_string_store(transactions(spark, sf_dir))
    # The faults follow from the order number at the end of the key.
    k = F.regexp_extract(F.col(":key"), "([0-9]+)$", 1).cast("long")
    changes = {
        "financial:amount": lambda c: F.when(k % 53 == 0, "n/a").otherwise(c),
        "metrics:amendment_count": lambda c: F.when(k % 59 != 0, c),
        "metrics:processing_days": lambda c: F.when(k % 61 == 0, "3.7").otherwise(c),
        "metrics:delay_flag": lambda c: F.when(k % 67 == 0, "").otherwise(c),
        "instrument:product_type": lambda c: F.when(k % 71 != 0, c),
    }
    return store.withColumns({n: f(F.col(f"`{n}`")) for n, f in changes.items()})


@query(
    "current_state_scan",
    """SELECT transaction_id, CAST(amount AS DOUBLE) AS amount,
    CASE WHEN order_key % 59 = 0 THEN 0 ELSE amendment_count END AS amendment_count, document_count,
    CASE WHEN order_key % 61 = 0 THEN 3 ELSE processing_days END AS processing_days,
    counterparty_relationship_years AS relationship_years, discrepancy_flag, delay_flag,
    CASE WHEN order_key % 71 = 0 THEN '' ELSE product_type END AS product_type, issue_date
    FROM tx WHERE order_key % 53 <> 0 AND order_key % 67 <> 0""",
    "tx",
)
def _(spark, sf_dir):
    readable, _ = state.current_state_scan(_string_store(spark, sf_dir))
    return readable


@query(
    "hive_typed_mapping",
    """SELECT transaction_id, CASE WHEN order_key % 71 <> 0 THEN product_type END AS product_type, status,
    issue_date, expiry_date, currency,
    CASE WHEN order_key % 53 <> 0 THEN CAST(amount AS DOUBLE) END AS amount,
    applicant_id, beneficiary_id, applicant_country, beneficiary_country, goods_category,
    CASE WHEN order_key % 59 <> 0 THEN amendment_count END AS amendment_count, document_count,
    CASE WHEN order_key % 61 <> 0 THEN processing_days END AS processing_days, discrepancy_flag,
    CASE WHEN order_key % 67 <> 0 THEN delay_flag END AS delay_flag, customer_risk_rating FROM tx""",
    "tx",
)
def _(spark, sf_dir):
    return state.hive_typed_mapping(_string_store(spark, sf_dir))


def _loaded(spark, sf_dir) -> DataFrame:
    """All transactions, bulk loaded into a key-sorted store."""
    return export.bulk_load(transactions(spark, sf_dir), scratch(spark, "store"), "bulk")


@query(
    "bulk_load",
    """SELECT transaction_id, product_type, status, issue_date, expiry_date, currency, CAST(amount AS DOUBLE) AS amount,
    applicant_id, beneficiary_id, applicant_country, beneficiary_country, goods_category, amendment_count,
    document_count, processing_days, discrepancy_flag, delay_flag, customer_risk_rating FROM tx""",
    "tx",
)
def _(spark, sf_dir):
    return state.hive_typed_mapping(_loaded(spark, sf_dir))


@query(
    "point_lookup",
    """SELECT transaction_id, product_type, status, currency, CAST(amount AS DOUBLE) AS amount, applicant_id,
    beneficiary_id FROM tx WHERE transaction_id = (SELECT max(transaction_id) FROM tx)""",
    "tx",
)
def _(spark, sf_dir):
    store = _loaded(spark, sf_dir)
    key = store.agg(F.max(":key")).first()[0]
    columns = "transaction_id product_type status currency amount applicant_id beneficiary_id".split()
    return state.hive_typed_mapping(state.point_lookup(store, key, ":key")).select(*columns)


@query(
    "prefix_scan",
    """SELECT transaction_id, product_type FROM tx WHERE starts_with(transaction_id, 'TF-1998')
    ORDER BY transaction_id LIMIT 5""",
    "tx",
)
def _(spark, sf_dir):
    found = state.prefix_scan(_loaded(spark, sf_dir), "TF-1998", 5, ":key")
    return state.hive_typed_mapping(found).select("transaction_id", "product_type")


@query(
    "lookup_id_guard",
    """SELECT o_orderpriority AS priority, count(*) AS accepted FROM orders
    WHERE regexp_full_match(o_orderkey || '.' || o_orderpriority, '[A-Za-z0-9._-]+') GROUP BY 1""",
)
def _(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.concat_ws(".", "o_orderkey", "o_orderpriority").alias("lookup_id"),
        F.col("o_orderpriority").alias("priority"),
    )
    accepted = state.lookup_id_guard(rows, "lookup_id")
    return accepted.groupBy("priority").agg(F.count(F.lit(1)).alias("accepted"))


@query(
    "transaction_validation",
    """SELECT * FROM (VALUES
      ('amount', (SELECT count(*) FROM tx WHERE order_key % 53 = 0)),
      ('amendment_count', (SELECT count(*) FROM tx WHERE order_key % 59 = 0)),
      ('document_count', 0::BIGINT), ('processing_days', 0::BIGINT), ('discrepancy_flag', 0::BIGINT),
      ('delay_flag', 0::BIGINT), ('counterparty_relationship_years', 0::BIGINT),
      ('issue_date', (SELECT count(*) FROM tx WHERE order_key % 61 = 0)),
      ('duplicate_transaction_id', (SELECT coalesce(sum(c), 0)::BIGINT FROM
        (SELECT count(*) AS c FROM tx GROUP BY substr(transaction_id, 1, 10) HAVING count(*) > 1)))
    ) v(check_name, problems)""",
    "tx",
)
def _(spark, sf_dir):
    rows = transactions(spark, sf_dir, [*TRANSACTION.fieldNames(), "order_key"])
    k = F.col("order_key")
    return quality.transaction_validation(
        rows.withColumns(
            {
                "amount": F.when(k % 53 == 0, "n/a").otherwise(F.col("amount").cast("string")),
                "amendment_count": F.when(k % 59 != 0, F.col("amendment_count")),
                "issue_date": F.when(k % 61 == 0, "soon").otherwise(F.col("issue_date")),
                # Ids cut short collide.
                "transaction_id": F.substring("transaction_id", 1, 10),
            }
        )
    )


# --- Sinks ------------------------------------------------------------------------------------


@query(
    "zone_landing",
    "SELECT 'raw/transactions' AS zone, count(*) AS records, CAST(sum(amount) AS DOUBLE) AS amount FROM tx",
    "tx",
)
def _(spark, sf_dir):
    base = scratch(spark, "zones")
    path = export.zone_landing(transactions(spark, sf_dir), base, "raw", "transactions")
    return spark.read.parquet(path).agg(
        F.lit("raw/transactions").alias("zone"),
        F.count(F.lit(1)).alias("records"),
        F.sum("amount").alias("amount"),
    )


@query("landing_inventory")
def _(spark, sf_dir):
    base = scratch(spark, "zones")
    export.zone_landing(transactions(spark, sf_dir), base, "raw", "transactions")
    listed = files.landing_inventory(spark, base)
    return listed.filter("path like '%.parquet'").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.min("bytes").alias("smallest")
    )


@query(
    "full_refresh",
    "SELECT product_type, count(*) AS records FROM tx GROUP BY 1",
    "tx",
)
def _(spark, sf_dir):
    path = scratch(spark, "refresh")
    rows = transactions(spark, sf_dir, ["transaction_id", "product_type"])
    # The second load replaces the first, so every row is there once.
    export.full_refresh(rows, path)
    stored = export.full_refresh(rows, path)
    return stored.groupBy("product_type").agg(F.count(F.lit(1)).alias("records"))


_PUBLISHED_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS report, count(*) AS groups, CAST(sum(c) AS BIGINT) AS transactions FROM "
    f"(SELECT count(*) AS c FROM tx GROUP BY {', '.join(portfolio.REPORTS[n][0].split())})"
    for n in export.PUBLISHED
)


@query("publish_bi_tables", _PUBLISHED_SQL, "tx")
def _(spark, sf_dir):
    paths = export.publish_bi_tables(transactions(spark, sf_dir), scratch(spark, "bi"))
    out = None
    for name, path in paths.items():
        part = spark.read.parquet(path).agg(
            F.lit(name).alias("report"),
            F.count(F.lit(1)).alias("groups"),
            F.sum("transaction_count").alias("transactions"),
        )
        out = part if out is None else out.unionByName(part)
    return out
