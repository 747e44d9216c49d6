"""Retail landing, validation, quarantine, integrity and summary queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions import as_decimal, as_smallint, clean, stripped
from tradeloom.operators import load, quality, retail
from tradeloom.plans.catalog import query
from tradeloom.plans.driver_tables import (
    landed_retail_events,
    retail_events,
    retail_products,
    retail_promotions,
    retail_stores,
    table,
)
from tradeloom.schemas import DATA_DICTIONARY_RAW, EXPECTED_COUNTS, RETAIL_EVENTS_RAW
from tradeloom.session import scratch
from tradeloom.sources import files
from tradeloom.sources.external import SOURCE_VIEWS, source_view
from tradeloom.sources.lookups import inline_values

_BAD = (
    "(no_transaction OR bad_time OR bad_quantity OR bad_price OR bad_discount OR bad_final "
    "OR bad_flag OR bad_reference)"
)
_REASON = """coalesce(nullif(concat_ws('; ', CASE WHEN no_transaction THEN 'Missing transaction_id' END,
  CASE WHEN bad_time THEN 'Invalid event_timestamp' END, CASE WHEN bad_quantity THEN 'Invalid quantity' END,
  CASE WHEN bad_price THEN 'Invalid unit_price' END, CASE WHEN bad_final THEN 'Invalid final_price' END), ''),
  'Failed source-data validation')"""


# --- Landing ----------------------------------------------------------------------------------


@query(
    "csv_staging_scan",
    """SELECT event_id, nullif(transaction_id, '') AS transaction_id, quantity, unit_price, promotion_id,
    trim(replace(loyalty_flag, chr(13), '')) AS loyalty_flag FROM landed""",
    "landed",
)
def _(spark, sf_dir):
    path = scratch(spark, "csv")
    landed_retail_events(spark, sf_dir).write.csv(path, header=True, quoteAll=True, escape='"')
    staged = files.csv_staging_scan(spark, path, RETAIL_EVENTS_RAW)
    return quality.clean_strings(staged).select(
        "event_id", "transaction_id", "quantity", "unit_price", "promotion_id", "loyalty_flag"
    )


@query(
    "data_dictionary_load",
    "SELECT DISTINCT p_name AS field_name, p_type AS generated_dtype, p_brand AS dataset FROM part",
)
def _(spark, sf_dir):
    source, target = scratch(spark, "dictionary-csv"), scratch(spark, "dictionary")
    parts = table(spark, sf_dir, "part").select("p_name", "p_type", "p_brand").distinct()
    raw = parts.select(
        F.concat(F.lit(" "), "p_name", F.lit("\r")).alias("field_name"),
        F.concat("p_type", F.lit("  ")).alias("generated_dtype"),
        F.concat("p_brand", F.lit("\r")).alias("dataset"),
    ).select(*DATA_DICTIONARY_RAW.fieldNames())
    raw.write.csv(source, header=True, quoteAll=True)
    return files.data_dictionary_load(spark, source, target)


@query(
    "inline_values",
    """SELECT v.payment_type, count(o_orderkey) AS orders
    FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW'), ('6-UNUSED')) v(payment_type)
    LEFT JOIN orders ON o_orderpriority = v.payment_type GROUP BY 1""",
)
def _(spark, sf_dir):
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-UNUSED"]
    lookup = inline_values(spark, "payment_type", names)
    used = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("payment_type"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return lookup.join(used, "payment_type", "left").select(
        "payment_type", F.coalesce("n", F.lit(0)).alias("orders")
    )


_VIEW_COUNTS = {
    "products": "all_products",
    "stores": "all_stores",
    "promotions": "all_promotions",
    "retail_events": "sales",
}


@query(
    "jdbc_view_source",
    " UNION ALL ".join(
        f"SELECT '{v}' AS view_name, {len(SOURCE_VIEWS[v])} AS columns, count(*) AS records FROM {r}"
        for v, r in _VIEW_COUNTS.items()
    ),
    "all_products all_stores all_promotions sales",
)
def _(spark, sf_dir):
    tables = {
        "products": retail_products(spark, sf_dir),
        "stores": retail_stores(spark, sf_dir),
        "promotions": retail_promotions(spark, sf_dir),
        "retail_events": retail_events(spark, sf_dir),
    }
    views = {n: source_view(rows, n) for n, rows in tables.items()}
    counts = quality.table_row_counts(views)
    widths = F.create_map(*[F.lit(x) for n, v in views.items() for x in (n, len(v.columns))])
    return counts.select(
        F.col("table_name").alias("view_name"),
        widths[F.col("table_name")].alias("columns"),
        F.col("record_count").alias("records"),
    )


# --- Cleaning and typing ----------------------------------------------------------------------


@query(
    "clean_strings",
    """SELECT event_id, transaction_id, quantity, promotion_id, loyalty_flag FROM judged""",
    "judged",
)
def _(spark, sf_dir):
    names = ["event_id", "transaction_id", "quantity", "promotion_id", "loyalty_flag"]
    return quality.clean_strings(landed_retail_events(spark, sf_dir, names))


def _landed_products(spark, sf_dir) -> DataFrame:
    """Product rows as text; some names blank, some prices unreadable or zero."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), k.cast("string")).alias("product_id"),
        F.when(k % 31 == 0, "  ").otherwise(F.col("p_name")).alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(k % 37 == 0, "free")
        .when(k % 41 == 0, "0.00\r")
        .otherwise(F.concat(F.col("p_retailprice").cast("decimal(12,2)").cast("string"), F.lit("\r")))
        .alias("base_unit_price"),
    )


_GOOD_PRODUCT = "p_partkey % 31 <> 0 AND p_partkey % 37 <> 0 AND p_partkey % 41 <> 0"


@query(
    "typed_products",
    f"""SELECT 'P' || p_partkey AS product_id, p_name AS product_name, p_type AS category,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS base_unit_price FROM part WHERE {_GOOD_PRODUCT}""",
)
def _(spark, sf_dir):
    return quality.typed_products(_landed_products(spark, sf_dir))


@query(
    "typed_stores",
    """SELECT 'ST-' || s_suppkey AS store_id, s_name AS store_city, n_name AS province, r_name AS store_region
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE s_suppkey % 11 <> 0 AND s_suppkey % 13 <> 0""",
)
def _(spark, sf_dir):
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    region, k = table(spark, sf_dir, "region"), F.col("s_suppkey")
    staged = (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("ST-"), k.cast("string")).alias("store_id"),
            F.when(k % 11 != 0, F.col("s_name")).alias("store_city"),
            F.col("n_name").alias("province"),
            F.when(k % 13 == 0, "\r").otherwise(F.concat(F.col("r_name"), F.lit("\r"))).alias("store_region"),
        )
    )
    return quality.typed_stores(staged)


@query(
    "typed_promotions",
    """SELECT promotion_id, product_id, promotion_name, CAST(start_date AS VARCHAR) AS start_date,
    CAST(end_date AS VARCHAR) AS end_date, CAST(discount_rate AS DOUBLE) AS discount_rate FROM all_promotions
    WHERE promotion_id NOT IN ('PR005', 'PR006', 'PR007')""",
    "all_promotions",
)
def _(spark, sf_dir):
    rows = retail_promotions(spark, sf_dir)
    promotion = F.col("promotion_id")
    staged = rows.select(
        "promotion_id",
        "product_id",
        "promotion_name",
        F.when(promotion == "PR005", "later").otherwise(F.col("start_date").cast("string")).alias("start_date"),
        F.when(promotion == "PR006", "1990-01-01").otherwise(F.col("end_date").cast("string")).alias("end_date"),
        F.when(promotion == "PR007", "1.5")
        .otherwise(F.concat(F.col("discount_rate").cast("string"), F.lit("\r")))
        .alias("discount_rate"),
    )
    return quality.typed_promotions(staged)


@query(
    "typed_retail_events",
    f"""SELECT event_id, transaction_id, store_id, store_city, province, store_region,
    strftime(CAST(event_timestamp AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS event_timestamp, product_id,
    product_name, category, q AS quantity, CAST(up AS DOUBLE) AS unit_price, CAST(dp AS DOUBLE) AS discount_amount,
    CAST(fp AS DOUBLE) AS final_price, promotion_flag, promotion_id, payment_type, loyalty_flag
    FROM judged WHERE NOT {_BAD}""",
    "judged",
)
def _(spark, sf_dir):
    return quality.typed_retail_events(landed_retail_events(spark, sf_dir))


@query(
    "fail_fast_gate",
    f"""SELECT 'Products' AS table_name, (SELECT count(*) FROM part WHERE NOT ({_GOOD_PRODUCT})) > 0 AS stopped,
      CASE WHEN (SELECT count(*) FROM part WHERE NOT ({_GOOD_PRODUCT})) > 0 THEN 50001 ELSE 0 END AS code
    UNION ALL SELECT 'RetailEvents', (SELECT count(*) FROM judged WHERE {_BAD}) > 0,
      CASE WHEN (SELECT count(*) FROM judged WHERE {_BAD}) > 0 THEN 50004 ELSE 0 END
    UNION ALL SELECT 'Stores', false, 0""",
    "judged",
)
def _(spark, sf_dir):
    staged = {
        "Products": _landed_products(spark, sf_dir),
        "RetailEvents": landed_retail_events(spark, sf_dir),
        "Stores": retail_stores(spark, sf_dir),
    }
    found = []
    for name, rows in staged.items():
        try:
            quality.fail_fast_gate(rows, name)
            found.append((name, False, 0))
        except quality.LoadRejected as stop:
            found.append((name, True, stop.code))
    return spark.createDataFrame(found, "table_name string, stopped boolean, code int")


@query(
    "quarantine_reasons",
    f"SELECT event_id, product_id, {_REASON} AS rejection_reason FROM judged WHERE {_BAD}",
    "judged",
)
def _(spark, sf_dir):
    rejected = quality.quarantine_reasons(landed_retail_events(spark, sf_dir))
    return rejected.select("event_id", "product_id", "rejection_reason")


def _unchecked(spark, sf_dir) -> DataFrame:
    """Landed sale lines read into types without validation."""
    names = "quantity unit_price discount_amount final_price promotion_flag promotion_id loyalty_flag"
    landed = landed_retail_events(spark, sf_dir, names.split())
    return landed.select(
        as_smallint("quantity").alias("quantity"),
        *[as_decimal(c).alias(c) for c in ("unit_price", "discount_amount", "final_price")],
        stripped("promotion_flag").alias("promotion_flag"),
        clean("promotion_id").alias("promotion_id"),
        F.col("loyalty_flag"),
    )


@query(
    "check_constraints",
    """SELECT * FROM (VALUES
    ('quantity_positive', (SELECT count(*) FROM judged WHERE q <= 0)),
    ('unit_price_positive', (SELECT count(*) FROM judged WHERE up <= 0)),
    ('discount_not_negative', (SELECT count(*) FROM judged WHERE dp < 0)),
    ('final_price_not_negative', (SELECT count(*) FROM judged WHERE fp < 0)),
    ('promotion_flag_domain', (SELECT count(*) FROM judged WHERE promotion_flag NOT IN ('Y', 'N'))),
    ('loyalty_flag_domain', (SELECT count(*) FROM landed WHERE loyalty_flag NOT IN ('Y', 'N'))),
    ('promotion_reference', (SELECT count(*) FROM judged WHERE bad_reference))) v(rule_name, violations)""",
    "judged",
)
def _(spark, sf_dir):
    return quality.check_constraints(_unchecked(spark, sf_dir))


@query(
    "promotion_reference_rule",
    """SELECT promotion_flag, promotion_id IS NOT NULL AS has_promotion, bad_reference AS broken,
    count(*) AS records FROM judged GROUP BY 1, 2, 3""",
    "judged",
)
def _(spark, sf_dir):
    rows = landed_retail_events(spark, sf_dir, ["promotion_flag", "promotion_id"])
    broken = quality.promotion_reference_broken(F.col("promotion_flag"), F.col("promotion_id"))
    return rows.groupBy(
        "promotion_flag", F.col("promotion_id").isNotNull().alias("has_promotion"), broken.alias("broken")
    ).agg(F.count(F.lit(1)).alias("records"))


# --- References and keys ----------------------------------------------------------------------


@query(
    "orphan_products",
    "SELECT event_id, product_id FROM sales WHERE product_id NOT IN (SELECT product_id FROM products)",
    "sales products",
)
def _(spark, sf_dir):
    facts = retail_events(spark, sf_dir, ["event_id", "product_id"])
    return quality.orphans(facts, retail_products(spark, sf_dir, gaps=True), "product_id").select(
        "event_id", "product_id"
    )


@query(
    "orphan_stores",
    "SELECT event_id, store_id FROM sales WHERE store_id NOT IN (SELECT store_id FROM stores)",
    "sales stores",
)
def _(spark, sf_dir):
    facts = retail_events(spark, sf_dir, ["event_id", "store_id"])
    known = retail_stores(spark, sf_dir, gaps=True)
    return quality.orphans(facts, known, "store_id").select("event_id", "store_id")


@query(
    "orphan_promotions",
    """SELECT event_id, promotion_id FROM sales WHERE promotion_id IS NOT NULL
    AND promotion_id NOT IN (SELECT promotion_id FROM promotions)""",
    "sales promotions",
)
def _(spark, sf_dir):
    facts = retail_events(spark, sf_dir, ["event_id", "promotion_id"])
    return quality.orphans(facts, retail_promotions(spark, sf_dir, gaps=True), "promotion_id").select(
        "event_id", "promotion_id"
    )


@query(
    "insert_missing_lookup",
    """SELECT store_city FROM stores UNION SELECT store_city FROM sales""",
    "stores sales",
)
def _(spark, sf_dir):
    target = retail_stores(spark, sf_dir, gaps=True).select("store_city")
    incoming = retail_events(spark, sf_dir, ["store_city"])
    return quality.insert_missing_lookup(target, incoming, "store_city")


def _fk(table_name: str, rows: str, key: str, dimension: str, dimension_key: str | None = None) -> str:
    return (
        f"SELECT '{table_name}' AS table_name, '{key}' AS column_name, CAST(count(*) AS BIGINT) AS violations "
        f"FROM {rows} f WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {dimension_key or key} FROM {dimension})"
    )


@query(
    "foreign_key_audit",
    " UNION ALL ".join(
        [
            _fk("RetailEvents", "sales", "store_id", "stores"),
            _fk("RetailEvents", "sales", "product_id", "products"),
            _fk("RetailEvents", "sales", "promotion_id", "promotions"),
            _fk("RetailEvents", "sales", "category", "products"),
            _fk("RetailEvents", "sales", "province", "stores"),
            _fk("RetailEvents", "sales", "store_region", "stores"),
            _fk("RetailEvents", "sales", "payment_type", "(SELECT '1-URGENT' AS payment_type UNION ALL SELECT '2-HIGH')"),
            _fk("Stores", "stores", "province", "nation", "n_name"),
            _fk("Stores", "stores", "store_region", "region", "r_name"),
            _fk("Products", "products", "category", "(SELECT 'STANDARD' AS category UNION ALL SELECT 'PROMO')"),
            _fk("Promotions", "promotions", "product_id", "products"),
        ]
    ),
    "sales stores products promotions",
)
def _(spark, sf_dir):
    products, stores = retail_products(spark, sf_dir, gaps=True), retail_stores(spark, sf_dir, gaps=True)
    promotions = retail_promotions(spark, sf_dir, gaps=True)
    payments = inline_values(spark, "payment_type", ["1-URGENT", "2-HIGH"])
    categories = inline_values(spark, "category", ["STANDARD", "PROMO"])
    event_keys = {
        "store_id": (stores, "store_id"),
        "product_id": (products, "product_id"),
        "promotion_id": (promotions, "promotion_id"),
        "category": (products, "category"),
        "province": (stores, "province"),
        "store_region": (stores, "store_region"),
        "payment_type": (payments, "payment_type"),
    }
    store_keys = {
        "province": (table(spark, sf_dir, "nation"), "n_name"),
        "store_region": (table(spark, sf_dir, "region"), "r_name"),
    }
    facts = retail_events(spark, sf_dir, list(event_keys))
    audits = [
        quality.foreign_key_audit(facts, event_keys, "RetailEvents"),
        quality.foreign_key_audit(stores, store_keys, "Stores"),
        quality.foreign_key_audit(products, {"category": (categories, "category")}, "Products"),
        quality.foreign_key_audit(promotions, {"product_id": (products, "product_id")}, "Promotions"),
    ]
    out = audits[0]
    for audit in audits[1:]:
        out = out.unionByName(audit)
    return out


@query(
    "duplicate_key_check",
    "SELECT event_id, count(*) AS occurrences FROM sales GROUP BY 1 HAVING count(*) > 1",
    "sales",
)
def _(spark, sf_dir):
    return quality.duplicate_key_check(retail_events(spark, sf_dir, ["event_id"]), "event_id")


def _stored(spark, sf_dir) -> dict[str, DataFrame]:
    categories = table(spark, sf_dir, "part").select("p_type").distinct()
    return {
        "ProductCategories": categories,
        "Provinces": table(spark, sf_dir, "nation"),
        "StoreRegions": table(spark, sf_dir, "region"),
        "PaymentTypes": table(spark, sf_dir, "orders").select("o_orderpriority").distinct(),
        "Products": retail_products(spark, sf_dir),
        "Stores": retail_stores(spark, sf_dir),
        "Promotions": retail_promotions(spark, sf_dir),
        "RetailEvents": retail_events(spark, sf_dir, ["event_id"]),
        "SourceDataDictionary": table(spark, sf_dir, "part").select("p_name", "p_brand").distinct(),
        "RejectedRetailEvents": quality.quarantine_reasons(landed_retail_events(spark, sf_dir)),
    }


_COUNTS = {
    "ProductCategories": "(SELECT DISTINCT p_type FROM part)",
    "Provinces": "nation",
    "StoreRegions": "region",
    "PaymentTypes": "(SELECT DISTINCT o_orderpriority FROM orders)",
    "Products": "all_products",
    "Stores": "all_stores",
    "Promotions": "all_promotions",
    "RetailEvents": "sales",
    "SourceDataDictionary": "(SELECT DISTINCT p_name, p_brand FROM part)",
    "RejectedRetailEvents": f"(SELECT * FROM judged WHERE {_BAD})",
}
_COUNT_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS record_count FROM {r}" for n, r in _COUNTS.items()
)


@query("table_row_counts", _COUNT_SQL, "all_products all_stores all_promotions sales judged")
def _(spark, sf_dir):
    return quality.table_row_counts(_stored(spark, sf_dir))


@query(
    "expected_count_gate",
    f"""SELECT e.table_name, c.record_count, e.expected_count, e.code, c.record_count = e.expected_count AS passed
    FROM (VALUES ('Products', 45::BIGINT, 51001), ('Stores', 12::BIGINT, 51002), ('Promotions', 8::BIGINT, 51003),
      ('RetailEvents', 38143::BIGINT, 51004), ('SourceDataDictionary', 18::BIGINT, 51005),
      ('RejectedRetailEvents', 2::BIGINT, 51006)) e(table_name, expected_count, code)
    JOIN ({_COUNT_SQL}) c ON c.table_name = e.table_name""",
    "all_products all_stores all_promotions sales judged",
)
def _(spark, sf_dir):
    return quality.expected_count_gate(quality.table_row_counts(_stored(spark, sf_dir)))


_LOADED = {"Products": "part", "Stores": "supplier", "Promotions": "all_promotions", "RetailEvents": "sales"}
_ATTEMPT_CODES = {
    "unknown products": "CASE WHEN EXISTS (SELECT 1 FROM sales WHERE product_id NOT IN (SELECT product_id FROM products)) THEN 51007 ELSE 0 END",
    "too few promotions": "51003",
    "clean": "0",
    "invalid lines": f"CASE WHEN EXISTS (SELECT 1 FROM judged WHERE {_BAD}) THEN 50004 ELSE 0 END",
}


@query(
    "retail_load",
    " UNION ALL ".join(
        f"SELECT '{attempt}' AS attempt, {code} AS code, '{name}' AS table_name, "
        + (f"(SELECT count(*) FROM {rows})" if attempt in ("clean", "invalid lines") else "CAST(0 AS BIGINT)")
        + " AS visible_records, "
        + (
            "(SELECT CAST(sum(final_price) AS DOUBLE) FROM sales)"
            if name == "RetailEvents" and attempt in ("clean", "invalid lines")
            else "CAST(NULL AS DOUBLE)"
        )
        + " AS visible_sales"
        for attempt, code in _ATTEMPT_CODES.items()
        for name, rows in _LOADED.items()
    ),
    "sales judged products all_promotions",
)
def _(spark, sf_dir):
    """Four loads in a row, two stopped before anything is published and one after, and what readers see then."""
    base = scratch(spark, "retail")
    lines = retail_events(spark, sf_dir)
    clean_lines = lines.select(
        *[F.col(c).cast("string").alias(c) for c in RETAIL_EVENTS_RAW.fieldNames()]
    )
    promotions = retail_promotions(spark, sf_dir).count()
    staged = {
        "Products": retail_products(spark, sf_dir),
        "Stores": retail_stores(spark, sf_dir),
        "Promotions": retail_promotions(spark, sf_dir),
        "RetailEvents": clean_lines,
    }
    attempts = {
        "unknown products": (staged | {"Products": retail_products(spark, sf_dir, gaps=True)}, promotions),
        "too few promotions": (staged, promotions + 1),
        "clean": (staged, promotions),
        "invalid lines": (staged | {"RetailEvents": landed_retail_events(spark, sf_dir)}, promotions),
    }
    seen = []
    for attempt, (tables, wanted) in attempts.items():
        code = 0
        try:
            load.retail_load(tables, base, expected={"Promotions": (wanted, EXPECTED_COUNTS["Promotions"][1])})
        except quality.LoadRejected as stop:
            code = stop.code
        for name in tables:
            rows = load.published_table(spark, base, name)
            if rows is None:
                rows = spark.createDataFrame([], "final_price decimal(12,2)")
            sales = F.sum("final_price") if "final_price" in rows.columns else F.lit(None)
            seen.append(
                rows.agg(F.count(F.lit(1)).alias("visible_records"), sales.cast("double").alias("visible_sales")).select(
                    F.lit(attempt).alias("attempt"),
                    F.lit(code).alias("code"),
                    F.lit(name).alias("table_name"),
                    "visible_records",
                    "visible_sales",
                )
            )
    return reduce(DataFrame.unionByName, seen)


# --- Summaries --------------------------------------------------------------------------------


@query(
    "retail_transaction_summary",
    """SELECT transaction_id, store_id, strftime(min(event_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS transaction_timestamp,
    count(*) AS product_line_count, CAST(sum(CAST(quantity AS BIGINT)) AS BIGINT) AS total_quantity,
    CAST(sum(final_price) AS DOUBLE) AS transaction_value, max(payment_type) AS payment_type,
    max(loyalty_flag) AS loyalty_flag FROM sales GROUP BY 1, 2""",
    "sales",
)
def _(spark, sf_dir):
    names = "transaction_id store_id event_timestamp quantity final_price payment_type loyalty_flag"
    return retail.retail_transaction_summary(retail_events(spark, sf_dir, names.split()))


@query(
    "store_sales_summary",
    """SELECT store_id, store_city, province, store_region, count(*) AS product_sale_events,
    count(DISTINCT transaction_id) AS transaction_count, CAST(sum(CAST(quantity AS BIGINT)) AS BIGINT) AS units_sold,
    CAST(sum(final_price) AS DOUBLE) AS total_sales FROM sales GROUP BY 1, 2, 3, 4""",
    "sales",
)
def _(spark, sf_dir):
    names = "store_id store_city province store_region transaction_id quantity final_price"
    return retail.store_sales_summary(retail_events(spark, sf_dir, names.split()))


@query(
    "retail_totals",
    """SELECT count(*) AS product_sale_events, count(DISTINCT transaction_id) AS transactions,
    strftime(min(event_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS first_event,
    strftime(max(event_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS last_event,
    CAST(sum(final_price) AS DOUBLE) AS total_sales FROM sales""",
    "sales",
)
def _(spark, sf_dir):
    names = "transaction_id event_timestamp final_price"
    return retail.retail_totals(retail_events(spark, sf_dir, names.split()))


@query(
    "first_events",
    """SELECT strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS event_timestamp, event_id, transaction_id,
    product_id, CAST(final_price AS DOUBLE) AS final_price FROM sales
    ORDER BY sales.event_timestamp, event_id, transaction_id, product_id, sales.final_price LIMIT 5""",
    "sales",
)
def _(spark, sf_dir):
    names = "event_timestamp event_id transaction_id product_id final_price"
    return retail.first_events(retail_events(spark, sf_dir, names.split()))
