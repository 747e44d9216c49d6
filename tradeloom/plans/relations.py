"""The domain relations once more, as SQL text for the checks."""

from __future__ import annotations

_PAD = "lpad(CAST({k} AS VARCHAR), CAST(greatest({w}, length(CAST({k} AS VARCHAR))) AS INTEGER), '0')"


def _pad(key: str, width: int) -> str:
    return _PAD.format(k=key, w=width)


def _choice(key: str, values: str) -> str:
    names = values.split()
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(names))
    return f"CASE {key} % {len(names)} {arms} END"


# name -> (relations it needs, query text)
RELATIONS: dict[str, tuple[str, str]] = {
    "tx": (
        "",
        f"""
SELECT concat('TF-', year(o.o_orderdate), '-', {_pad('o.o_orderkey', 7)}) AS transaction_id,
  {_choice('o.o_orderkey', 'IMPORT_LC EXPORT_LC GUARANTEE COLLECTION')} AS product_type,
  concat('CUST-', {_pad('o.o_custkey', 5)}) AS applicant_id,
  'CP-' || {_pad('fl.sk', 5)} AS beneficiary_id,
  an.n_name AS applicant_country, bn.n_name AS beneficiary_country,
  {_choice('o.o_orderkey', 'CAD USD EUR GBP JPY CNY XXX')} AS currency,
  CAST(o.o_totalprice * 4 AS DECIMAL(18,2)) AS amount,
  CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS issue_date,
  CAST(CAST(o.o_orderdate AS DATE) + CAST(60 + o.o_orderkey % 121 AS INTEGER) AS VARCHAR) AS expiry_date,
  CASE o.o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'P' THEN 'SETTLED' ELSE 'CLOSED' END AS status,
  p.p_type AS goods_category,
  CAST((o.o_orderkey + o.o_custkey) % 6 AS INTEGER) AS amendment_count,
  CAST(coalesce(fl.n_lines, 0) AS INTEGER) AS document_count,
  CAST(1 + (o.o_orderkey * 31 + o.o_custkey) % 20 AS INTEGER) AS processing_days,
  CAST(coalesce(fl.flag, 0) AS INTEGER) AS discrepancy_flag,
  CAST(CASE WHEN 1 + (o.o_orderkey * 31 + o.o_custkey) % 20 > 10 THEN 1 ELSE 0 END AS INTEGER) AS delay_flag,
  CAST(o.o_custkey % 16 AS INTEGER) AS counterparty_relationship_years,
  CASE WHEN c.c_mktsegment = 'MACHINERY' THEN 'HIGH'
       WHEN c.c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'MEDIUM' ELSE 'LOW' END AS customer_risk_rating,
  o.o_orderkey AS order_key, o.o_custkey AS customer_key
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation an ON an.n_nationkey = c.c_nationkey
LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS sk, min(l_partkey) AS pk, count(*) AS n_lines,
             max(CASE WHEN l_returnflag = 'R' AND l_discount >= 0.09 THEN 1 ELSE 0 END) AS flag
           FROM lineitem GROUP BY l_orderkey) fl ON fl.l_orderkey = o.o_orderkey
LEFT JOIN supplier s ON s.s_suppkey = fl.sk
LEFT JOIN nation bn ON bn.n_nationkey = s.s_nationkey
LEFT JOIN part p ON p.p_partkey = fl.pk
""",
    ),
    "valued": (
        "tx",
        """
SELECT tx.*, substr(issue_date, 1, 4) AS issue_year,
  CAST(CASE currency WHEN 'CAD' THEN 1.0000 WHEN 'USD' THEN 1.3600 WHEN 'EUR' THEN 1.4800
    WHEN 'GBP' THEN 1.7300 WHEN 'JPY' THEN 0.0092 WHEN 'CNY' THEN 0.1900 END AS DECIMAL(5,4)) AS rate,
  amount * CAST(CASE currency WHEN 'CAD' THEN 1.0000 WHEN 'USD' THEN 1.3600 WHEN 'EUR' THEN 1.4800
    WHEN 'GBP' THEN 1.7300 WHEN 'JPY' THEN 0.0092 WHEN 'CNY' THEN 0.1900 END AS DECIMAL(5,4)) AS amount_cad
FROM tx
""",
    ),
    # One row per event; columns are what a reader of its envelope must find.
    "log": (
        "",
        f"""
SELECT event_id AS n,
  event_id % 41 <> 0 AS readable,
  event_id % 37 = 0 AS is_fx,
  event_id % 43 = 0 AS null_payload,
  'EV-' || {_pad('event_id', 10)} AS event_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_time,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS record_time,
  CASE WHEN event_id % 37 = 0 THEN 'FX_RATE_UPDATED'
    ELSE CASE event_type WHEN 'click' THEN 'LC_AMENDED' WHEN 'view' THEN 'DOCUMENT_PRESENTED'
      WHEN 'purchase' THEN 'PAYMENT_SETTLED' WHEN 'signup' THEN 'GUARANTEE_ISSUED'
      ELSE 'UNROUTED_EVENT' END END AS event_type,
  CASE WHEN event_id % 37 = 0 THEN 'REFERENCE' WHEN event_id % 47 <> 0
    THEN 'TF-2024-' || {_pad('user_id', 7)} END AS transaction_id,
  CASE WHEN event_id % 37 = 0 THEN 'FX_RATE' WHEN event_type = 'view' THEN 'DOCUMENT'
    ELSE 'LETTER_OF_CREDIT' END AS aggregate_type,
  CASE WHEN event_id % 37 = 0 THEN {_choice('event_id', 'CAD USD EUR GBP JPY CNY')} || 'CAD'
    WHEN event_type = 'view' THEN 'DOC-' || CAST(event_id % 997 AS VARCHAR)
    ELSE 'TF-2024-' || {_pad('user_id', 7)} END AS aggregate_id,
  CASE WHEN event_id % 11 <> 0 THEN '1.0' END AS schema_version,
  CAST(user_id % 3 AS INTEGER) AS partition,
  event_type AS raw_type, user_id
FROM events
""",
    ),
    "env": (
        "log",
        f"""
SELECT log.*,
  CASE WHEN event_type LIKE 'LC\\_%' ESCAPE '\\' THEN 'tf.lc.events'
    WHEN event_type LIKE 'GUARANTEE\\_%' ESCAPE '\\' THEN 'tf.guarantee.events'
    WHEN event_type LIKE 'PAYMENT\\_%' ESCAPE '\\' THEN 'tf.payment.events'
    WHEN event_type LIKE 'DOCUMENT%' THEN 'tf.document.events'
    WHEN event_type LIKE 'FX\\_%' ESCAPE '\\' THEN 'tf.fx.events' ELSE 'tf.dlq.events' END AS topic,
  readable AND NOT null_payload AS has_payload,
  CASE WHEN readable AND NOT null_payload AND NOT is_fx THEN 'TF-2024-' || {_pad('user_id', 7)} END AS p_transaction_id,
  CASE WHEN readable AND NOT null_payload AND NOT is_fx THEN {_choice('user_id', 'IMPORT_LC EXPORT_LC GUARANTEE COLLECTION')} END AS product_type,
  CASE WHEN readable AND NOT null_payload AND NOT is_fx THEN 'CA' END AS applicant_country,
  CASE WHEN readable AND NOT null_payload AND NOT is_fx THEN 'NATION_' || CAST(user_id % 25 AS VARCHAR) END AS beneficiary_country,
  CASE WHEN readable AND NOT null_payload AND NOT is_fx THEN {_choice('(user_id + n)', 'CAD USD EUR GBP JPY CNY')} END AS currency,
  CASE WHEN readable AND NOT null_payload AND NOT is_fx
    THEN CAST(((user_id * 7919 + n * 31) % 2000) * 1000 + 0.50 AS DECIMAL(18,2)) END AS amount,
  CASE WHEN readable AND NOT null_payload AND NOT is_fx THEN {_choice('n', 'ACTIVE SETTLED CLOSED')} END AS status,
  CASE WHEN readable AND NOT null_payload AND NOT is_fx AND n % 5 <> 0 THEN CAST(1 + n % 20 AS INTEGER) END AS processing_days,
  CASE WHEN readable AND NOT null_payload AND NOT is_fx THEN CAST((user_id + n) % 4 = 0 AS INTEGER) END AS discrepancy_flag,
  CASE WHEN readable AND NOT null_payload AND NOT is_fx THEN CAST((user_id + n) % 2 = 0 AS INTEGER) END AS delay_flag,
  CASE WHEN readable AND NOT null_payload AND NOT is_fx THEN {_choice('(user_id + n)', 'HIGH MEDIUM LOW')} END AS customer_risk_rating,
  CASE WHEN readable AND NOT null_payload AND NOT is_fx AND raw_type = 'view'
    THEN {_choice('n', 'COMMERCIAL_INVOICE PACKING_LIST')} END AS document_type,
  CASE WHEN readable AND NOT null_payload AND is_fx AND n % 74 <> 0 THEN {_choice('n', 'CAD USD EUR GBP JPY CNY')} END AS base_currency,
  CASE WHEN readable AND NOT null_payload AND is_fx THEN 'CAD' END AS quote_currency,
  CASE WHEN readable AND NOT null_payload AND is_fx THEN CAST(1 + (n % 100) / 1000.0 AS DECIMAL(18,6)) END AS rate
FROM log
""",
    ),
    # What the consumer makes of the subscribed records.
    "checked": (
        "env",
        """
SELECT env.*,
  CASE WHEN NOT readable THEN 'missing event_id, event_type, event_time, source, aggregate_type, aggregate_id, transaction_id'
    WHEN transaction_id IS NULL THEN 'missing transaction_id' END AS contract_error,
  CASE WHEN NOT readable OR transaction_id IS NULL THEN NULL
    WHEN null_payload THEN 'null payload'
    WHEN is_fx AND base_currency IS NULL THEN 'incomplete rate' END AS projection_error
FROM env WHERE topic <> 'tf.dlq.events'
""",
    ),
    "uniq": (
        "env",
        """
SELECT transaction_id, product_type, beneficiary_country, currency, amount, customer_risk_rating,
  discrepancy_flag, delay_flag
FROM (SELECT env.*, row_number() OVER (PARTITION BY transaction_id ORDER BY record_time, topic, partition, n) AS rn
      FROM env WHERE topic <> 'tf.dlq.events' AND readable AND transaction_id LIKE 'TF-%'
        AND amount IS NOT NULL AND currency IS NOT NULL)
WHERE rn = 1
""",
    ),
    "sales": (
        "",
        """
SELECT concat_ws('-', 'EVT', l_orderkey, l_linenumber) AS event_id,
  'TXN-' || l_orderkey AS transaction_id, 'ST-' || l_suppkey AS store_id,
  s_name AS store_city, n_name AS province, r_name AS store_region,
  l_shipdate AS event_timestamp, 'P' || l_partkey AS product_id,
  p_name AS product_name, p_type AS category,
  CAST(l_quantity AS SMALLINT) AS quantity,
  CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(6,2)) AS DECIMAL(12,2)) AS discount_amount,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2))
    - CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(6,2)) AS DECIMAL(12,2))
    AS DECIMAL(12,2)) AS final_price,
  CASE WHEN l_discount >= 0.05 THEN 'Y' ELSE 'N' END AS promotion_flag,
  CASE WHEN l_discount >= 0.05 THEN 'PR' || lpad(CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR), 3, '0') END AS promotion_id,
  o_orderpriority AS payment_type,
  CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS loyalty_flag,
  l_partkey AS part_key
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
JOIN region ON r_regionkey = n_regionkey JOIN part ON p_partkey = l_partkey
JOIN orders ON o_orderkey = l_orderkey
""",
    ),
    "landed": (
        "sales",
        """
SELECT event_id,
  CASE WHEN part_key % 79 = 0 THEN '' ELSE transaction_id END AS transaction_id,
  store_id, store_city, province, store_region,
  CASE WHEN part_key % 83 = 0 THEN 'not-a-date' ELSE CAST(CAST(event_timestamp AS DATE) AS VARCHAR) END AS event_timestamp,
  product_id, product_name, category,
  CASE WHEN part_key % 97 = 0 THEN 'two' WHEN part_key % 89 = 0 THEN '-1' ELSE CAST(quantity AS VARCHAR) END AS quantity,
  CASE WHEN part_key % 73 = 0 THEN '-5.0' ELSE CAST(unit_price AS VARCHAR) END AS unit_price,
  CAST(discount_amount AS VARCHAR) AS discount_amount, CAST(final_price AS VARCHAR) AS final_price,
  CASE WHEN part_key % 71 = 0 THEN 'Y' ELSE promotion_flag END AS promotion_flag,
  CASE WHEN part_key % 71 <> 0 THEN promotion_id END AS promotion_id,
  payment_type,
  CASE WHEN part_key % 67 = 0 THEN loyalty_flag || chr(13) ELSE loyalty_flag END AS loyalty_flag
FROM sales
""",
    ),
    # Landed rows with cleaned text, values read where they can be, and the verdict per row.
    "judged": (
        "landed",
        """
SELECT c.*,
  (transaction_id IS NULL) AS no_transaction,
  (try_cast(event_timestamp AS TIMESTAMP) IS NULL) AS bad_time,
  (q IS NULL OR q <= 0) AS bad_quantity,
  (up IS NULL OR up <= 0) AS bad_price,
  (dp IS NULL OR dp < 0) AS bad_discount,
  (fp IS NULL OR fp < 0) AS bad_final,
  (promotion_flag NOT IN ('Y', 'N') OR loyalty_flag NOT IN ('Y', 'N')) AS bad_flag,
  ((promotion_flag = 'Y' AND promotion_id IS NULL) OR (promotion_flag = 'N' AND promotion_id IS NOT NULL)) AS bad_reference
FROM (
  SELECT event_id, nullif(trim(transaction_id), '') AS transaction_id, store_id, store_city, province,
    store_region, event_timestamp, product_id, product_name, category, quantity, unit_price,
    discount_amount, final_price, promotion_flag, promotion_id, payment_type,
    trim(replace(loyalty_flag, chr(13), '')) AS loyalty_flag,
    CASE WHEN regexp_full_match(quantity, '[+-]?[0-9]+') THEN try_cast(quantity AS SMALLINT) END AS q,
    try_cast(unit_price AS DECIMAL(12,2)) AS up,
    try_cast(discount_amount AS DECIMAL(12,2)) AS dp,
    try_cast(final_price AS DECIMAL(12,2)) AS fp
  FROM landed) c
""",
    ),
    "all_products": (
        "",
        """
SELECT 'P' || p_partkey AS product_id, p_name AS product_name, p_type AS category,
  CAST(p_retailprice AS DECIMAL(12,2)) AS base_unit_price, p_partkey
FROM part
""",
    ),
    "products": ("all_products", "SELECT * FROM all_products WHERE p_partkey % 50 <> 0"),
    "stores": ("all_stores", "SELECT * FROM all_stores WHERE CAST(substr(store_id, 4) AS BIGINT) % 7 <> 0"),
    "promotions": ("all_promotions", "SELECT * FROM all_promotions WHERE promotion_id <> 'PR010'"),
    "all_stores": (
        "",
        """
SELECT 'ST-' || s_suppkey AS store_id, s_name AS store_city, n_name AS province, r_name AS store_region
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""",
    ),
    "all_promotions": (
        "",
        """
SELECT 'PR' || lpad(CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR), 3, '0') AS promotion_id,
  'P' || min(l_partkey) AS product_id,
  'Discount ' || CAST(round(l_discount * 100) AS INTEGER) AS promotion_name,
  CAST(min(l_shipdate) AS DATE) AS start_date, CAST(max(l_shipdate) AS DATE) AS end_date,
  CAST(CAST(round(l_discount * 100) AS INTEGER) * 0.01 AS DECIMAL(6,4)) AS discount_rate
FROM lineitem WHERE l_discount >= 0.05 GROUP BY round(l_discount * 100)
""",
    ),
    "scores": (
        "",
        """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS y,
  0.6e0 * (((o_orderkey * 7919 + o_custkey * 104729) % 10007) / 10007.0e0)
    + 0.4e0 * CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS p
FROM orders
""",
    ),
    # Transactions with stand-in model outputs.
    "outputs": (
        "tx",
        """
SELECT tx.*,
  ((order_key * 7919 + customer_key * 104729) % 10007) / 10007.0e0 AS anomaly_score,
  ((order_key * 31 + customer_key * 17) % 1009) / 1009.0e0 AS discrepancy_probability,
  ((order_key * 13 + customer_key * 7) % 2003) / 2003.0e0 AS delay_probability,
  processing_days * 1.0e0 AS predicted_processing_days
FROM tx
""",
    ),
    "placed": (
        "outputs",
        """
SELECT outputs.*,
  CASE WHEN anomaly_score >= (SELECT quantile_cont(anomaly_score, 0.95) FROM outputs) THEN 'HIGH' ELSE 'NORMAL' END AS anomaly_class,
  round(CAST((0.25e0 * ((rank() OVER (ORDER BY anomaly_score)
      + (count(*) OVER (PARTITION BY anomaly_score) - 1) / 2.0e0) / CAST(count(*) OVER () AS DOUBLE))
    + 0.30e0 * discrepancy_probability + 0.35e0 * delay_probability
    + 0.10e0 * CASE customer_risk_rating WHEN 'LOW' THEN 0.0e0 WHEN 'HIGH' THEN 1.0e0 ELSE 0.5e0 END)
    * 100 AS DECIMAL(38,8)), 2) AS overall_risk_score
FROM outputs
""",
    ),
    "levelled": (
        "placed",
        """
SELECT placed.*, CASE WHEN overall_risk_score >= 65 THEN 'HIGH' WHEN overall_risk_score >= 40 THEN 'MEDIUM'
  ELSE 'LOW' END AS overall_risk_level
FROM placed
""",
    ),
}
