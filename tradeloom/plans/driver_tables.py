"""Domain relations as projections of the given TPC-H-like tables.

Each relation is described by its columns and by the joins every column needs. A caller names the
columns it uses and only those joins enter the plan: all joins go from a fact to the primary key of
another table, so leaving one out changes no row. No side carries a broadcast hint; Spark broadcasts
a side when its measured size allows it and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradeloom.functions import from_choices
from tradeloom.operators.events import route_topic
from tradeloom.schemas import KAFKA_RECORD, MONEY, PRICE
from tradeloom.session import landed

_CURRENCIES = ("CAD", "USD", "EUR", "GBP", "JPY", "CNY")
_PRODUCTS = ("IMPORT_LC", "EXPORT_LC", "GUARANTEE", "COLLECTION")


_LAYOUTS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its layout is taken from the files once and declared from then on."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _LAYOUTS:
        _LAYOUTS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_LAYOUTS[path]).parquet(path)


def _padded(prefix: str, key: str, width: int) -> Column:
    """Prefix and zero-padded key; a key longer than the width keeps all its digits."""
    return F.expr(
        f"concat('{prefix}', lpad(cast({key} as string), greatest({width}, length(cast({key} as string))), '0'))"
    )


def _project(
    base: DataFrame,
    columns: dict[str, tuple[str, Column]],
    joins: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]],
    wanted: Iterable[str] | None,
) -> DataFrame:
    """Select ``wanted`` from ``base`` with the joins those columns need, in the order of ``joins``.

    A join comes after its prerequisite. The largest tables come first: these are the joins that shuffle, and
    rows are narrow before the columns of the smaller tables are joined on.
    """
    names = list(wanted) if wanted is not None else list(columns)
    needed: set[str] = set()

    def require(join: str) -> None:
        if join and join not in needed:
            require(joins[join][0])
            needed.add(join)

    for name in names:
        for join in columns[name][0].split():
            require(join)
    for join in joins:
        if join in needed:
            base = joins[join][1](base)
    return base.select(*[columns[n][1].alias(n) for n in names])


def first_line_facts(lineitem: DataFrame) -> DataFrame:
    """One row per order: smallest supplier and part key, line count, late-return flag."""
    return lineitem.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("first_suppkey"),
        F.min("l_partkey").alias("first_partkey"),
        F.count(F.lit(1)).alias("n_lines"),
        F.max(((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.09)).cast("int")).alias(
            "late_return"
        ),
    )


def transactions(
    spark: SparkSession,
    sf_dir: str,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Trade transactions, one per order."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    day = F.col("o_orderdate").cast("date")
    days = (F.lit(1) + (key * 31 + cust) % 20).cast("int")
    rating = (
        F.when(F.col("c_mktsegment") == "MACHINERY", "HIGH")
        .when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), "MEDIUM")
        .otherwise("LOW")
    )
    specs = {
        "transaction_id": (
            "",
            F.concat(
                F.lit("TF-"), F.year(day).cast("string"), F.lit("-"), _padded("", "o_orderkey", 7)
            ),
        ),
        "product_type": ("", from_choices(key, _PRODUCTS)),
        "applicant_id": ("", _padded("CUST-", "o_custkey", 5)),
        "beneficiary_id": ("lines", _padded("CP-", "first_suppkey", 5)),
        "applicant_country": ("applicant", F.col("applicant_name")),
        "beneficiary_country": ("beneficiary", F.col("beneficiary_name")),
        "currency": ("", from_choices(key, (*_CURRENCIES, "XXX"))),
        "amount": ("", (F.col("o_totalprice") * 4).cast(MONEY)),
        "issue_date": ("", day.cast("string")),
        "expiry_date": ("", F.date_add(day, (F.lit(60) + key % 121).cast("int")).cast("string")),
        "status": (
            "",
            F.when(F.col("o_orderstatus") == "O", "ACTIVE")
            .when(F.col("o_orderstatus") == "P", "SETTLED")
            .otherwise("CLOSED"),
        ),
        "goods_category": ("part", F.col("p_type")),
        "amendment_count": ("", ((key + cust) % 6).cast("int")),
        "document_count": ("lines", F.coalesce(F.col("n_lines"), F.lit(0)).cast("int")),
        "processing_days": ("", days),
        "discrepancy_flag": ("lines", F.coalesce(F.col("late_return"), F.lit(0)).cast("int")),
        "delay_flag": ("", (days > 10).cast("int")),
        "counterparty_relationship_years": ("", (cust % 16).cast("int")),
        "customer_risk_rating": ("customer", rating),
        # The plain order and customer keys, for test scores and sampling keys.
        "order_key": ("", key),
        "customer_key": ("", cust),
    }

    def read(name: str, *pairs: str) -> DataFrame:
        return table(spark, sf_dir, name).selectExpr(*pairs)

    joins = {
        "lines": (
            "",
            lambda d: d.join(
                first_line_facts(table(spark, sf_dir, "lineitem")), key == F.col("l_orderkey"), "left"
            ),
        ),
        "customer": (
            "",
            lambda d: d.join(
                read("customer", "c_custkey", "c_nationkey", "c_mktsegment"),
                cust == F.col("c_custkey"),
                "left",
            ),
        ),
        "applicant": (
            "customer",
            lambda d: d.join(
                read("nation", "n_nationkey AS applicant_key", "n_name AS applicant_name"),
                F.col("c_nationkey") == F.col("applicant_key"),
                "left",
            ),
        ),
        "supplier": (
            "lines",
            lambda d: d.join(
                read("supplier", "s_suppkey", "s_nationkey"),
                F.col("first_suppkey") == F.col("s_suppkey"),
                "left",
            ),
        ),
        "beneficiary": (
            "supplier",
            lambda d: d.join(
                read("nation", "n_nationkey AS beneficiary_key", "n_name AS beneficiary_name"),
                F.col("s_nationkey") == F.col("beneficiary_key"),
                "left",
            ),
        ),
        "part": (
            "lines",
            lambda d: d.join(
                read("part", "p_partkey", "p_type"), F.col("first_partkey") == F.col("p_partkey"), "left"
            ),
        ),
    }
    default = [c for c in specs if c not in ("order_key", "customer_key")]
    return _project(
        table(spark, sf_dir, "orders"), specs, joins, default if columns is None else columns
    )


def event_log(events: DataFrame) -> DataFrame:
    """Kafka-shaped log of event envelopes made from the ``events`` table (batch or stream).

    Some records are unreadable, some carry an explicit null payload, some lack a transaction id
    and some reference rates lack their base currency, so that every reject path has rows.
    """
    n, user = F.col("event_id"), F.col("user_id")
    is_fx = n % 37 == 0
    event_type = (
        F.when(is_fx, "FX_RATE_UPDATED")
        .when(F.col("event_type") == "click", "LC_AMENDED")
        .when(F.col("event_type") == "view", "DOCUMENT_PRESENTED")
        .when(F.col("event_type") == "purchase", "PAYMENT_SETTLED")
        .when(F.col("event_type") == "signup", "GUARANTEE_ISSUED")
        .otherwise("UNROUTED_EVENT")
    )
    transaction = F.when(is_fx, F.lit("REFERENCE")).when(n % 47 != 0, _padded("TF-2024-", "user_id", 7))
    aggregate_id = (
        F.when(is_fx, F.concat(from_choices(n, _CURRENCIES), F.lit("CAD")))
        .when(F.col("event_type") == "view", F.concat(F.lit("DOC-"), (n % 997).cast("string")))
        .otherwise(_padded("TF-2024-", "user_id", 7))
    )
    trade = {
        "transaction_id": _padded("TF-2024-", "user_id", 7),
        "product_type": from_choices(user, _PRODUCTS),
        "applicant_country": F.lit("CA"),
        "beneficiary_country": F.concat(F.lit("NATION_"), (user % 25).cast("string")),
        "currency": from_choices(user + n, _CURRENCIES),
        "amount": (((user * 7919 + n * 31) % 2000) * 1000 + 0.50).cast(MONEY),
        "status": from_choices(n, ("ACTIVE", "SETTLED", "CLOSED")),
        "processing_days": F.when(n % 5 != 0, 1 + n % 20).cast("int"),
        "discrepancy_flag": ((user + n) % 4 == 0).cast("int"),
        "delay_flag": ((user + n) % 2 == 0).cast("int"),
        "customer_risk_rating": from_choices(user + n, ("HIGH", "MEDIUM", "LOW")),
        "document_type": F.when(
            F.col("event_type") == "view", from_choices(n, ("COMMERCIAL_INVOICE", "PACKING_LIST"))
        ),
    }
    rate = {
        "base_currency": F.when(n % 74 != 0, from_choices(n, _CURRENCIES)),
        "quote_currency": F.lit("CAD"),
        "rate": (1 + (n % 100) / 1000.0).cast("decimal(18,6)"),
    }
    payload = F.struct(
        *[F.when(~is_fx, c).alias(name) for name, c in trade.items()],
        *[F.when(is_fx, c).alias(name) for name, c in rate.items()],
    )
    head = F.to_json(
        F.struct(
            _padded("EV-", "event_id", 10).alias("event_id"),
            event_type.alias("event_type"),
            F.concat(
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")
            ).alias("event_time"),
            F.lit("driver").alias("source"),
            F.when(is_fx, "FX_RATE")
            .when(F.col("event_type") == "view", "DOCUMENT")
            .otherwise("LETTER_OF_CREDIT")
            .alias("aggregate_type"),
            aggregate_id.alias("aggregate_id"),
            transaction.alias("transaction_id"),
            F.when(n % 11 != 0, "1.0").alias("schema_version"),
        )
    )
    body = F.when(n % 43 == 0, F.lit("null")).otherwise(F.to_json(payload))
    value = F.when(n % 41 == 0, F.lit("not json")).otherwise(
        F.concat(F.rtrim(head, F.lit("}")), F.lit(',"payload":'), body, F.lit("}"))
    )
    return events.select(
        transaction.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        route_topic(event_type).alias("topic"),
        (user % 3).cast("int").alias("partition"),
        n.cast("long").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    ).select(*KAFKA_RECORD.fieldNames())


# Records of a landed file, at least; a table has at most about so many files.
FILE_RECORDS, MOST_FILES = 1 << 14, 10_000


def _per_file(rows: DataFrame) -> int:
    return max(FILE_RECORDS, rows.count() // MOST_FILES)


def landed_log(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the event log, landed as a topic's files are."""
    events = table(spark, sf_dir, "events")
    return landed(spark, f"log:{sf_dir}", lambda: event_log(events), _per_file(events))


def retail_events(
    spark: SparkSession,
    sf_dir: str,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Retail sale lines with types, one per order line."""
    gross = F.col("l_extendedprice").cast(MONEY)
    discount = (gross * F.col("l_discount").cast("decimal(6,2)")).cast(PRICE)
    promoted = F.col("l_discount") >= 0.05
    specs = {
        "event_id": (
            "",
            F.concat_ws("-", F.lit("EVT"), F.col("l_orderkey"), F.col("l_linenumber")),
        ),
        "transaction_id": ("", F.concat(F.lit("TXN-"), F.col("l_orderkey").cast("string"))),
        "store_id": ("", F.concat(F.lit("ST-"), F.col("l_suppkey").cast("string"))),
        "store_city": ("supplier", F.col("s_name")),
        "province": ("nation", F.col("n_name")),
        "store_region": ("region", F.col("r_name")),
        "event_timestamp": ("", F.col("l_shipdate")),
        "product_id": ("", F.concat(F.lit("P"), F.col("l_partkey").cast("string"))),
        "product_name": ("part", F.col("p_name")),
        "category": ("part", F.col("p_type")),
        "quantity": ("", F.col("l_quantity").cast("smallint")),
        "unit_price": ("part", F.col("unit_price")),
        "discount_amount": ("", discount),
        "final_price": ("", (gross - discount).cast(PRICE)),
        "promotion_flag": ("", F.when(promoted, "Y").otherwise("N")),
        "promotion_id": (
            "",
            F.when(
                promoted,
                F.concat(
                    F.lit("PR"), F.lpad((F.col("l_discount") * 100).try_cast("decimal(6,0)").cast("string"), 3, "0")
                ),
            ),
        ),
        "payment_type": ("orders", F.col("o_orderpriority")),
        "loyalty_flag": ("", F.when(F.col("l_returnflag") == "R", "Y").otherwise("N")),
        "part_key": ("", F.col("l_partkey")),
    }

    def dimension(name: str, fact_key: str, primary_key: str, *rest: str | Column):
        return lambda d: d.join(
            table(spark, sf_dir, name).select(primary_key, *rest),
            F.col(fact_key) == F.col(primary_key),
            "left",
        )

    # The price is read once per part, not once per line.
    price = F.col("p_retailprice").cast(PRICE).alias("unit_price")
    joins = {
        "orders": ("", dimension("orders", "l_orderkey", "o_orderkey", "o_orderpriority")),
        "part": ("", dimension("part", "l_partkey", "p_partkey", "p_name", "p_type", price)),
        "supplier": ("", dimension("supplier", "l_suppkey", "s_suppkey", "s_name", "s_nationkey")),
        "nation": (
            "supplier",
            dimension("nation", "s_nationkey", "n_nationkey", "n_name", "n_regionkey"),
        ),
        "region": ("nation", dimension("region", "n_regionkey", "r_regionkey", "r_name")),
    }
    default = [c for c in specs if c != "part_key"]
    return _project(
        table(spark, sf_dir, "lineitem"), specs, joins, default if columns is None else columns
    )


def landed_retail_events(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """``retail_events`` as they are landed: all text, with faults planted by part key.

    A query reads them once, so they are derived where they are read and no copy is written.
    """
    names = list(_RETAIL_NAMES if columns is None else columns)
    typed = retail_events(spark, sf_dir, [*names, "part_key"])
    k = F.col("part_key")

    def text(name: str) -> Column:
        return F.col(name).cast("string")

    faults = {
        "quantity": lambda c: F.when(k % 97 == 0, "two").when(k % 89 == 0, "-1").otherwise(c),
        "event_timestamp": lambda c: F.when(k % 83 == 0, "not-a-date").otherwise(c),
        "transaction_id": lambda c: F.when(k % 79 == 0, "").otherwise(c),
        "unit_price": lambda c: F.when(k % 73 == 0, "-5.0").otherwise(c),
        "promotion_flag": lambda c: F.when(k % 71 == 0, "Y").otherwise(c),
        "promotion_id": lambda c: F.when(k % 71 != 0, c),
        "loyalty_flag": lambda c: F.when(k % 67 == 0, F.concat(c, F.lit("\r"))).otherwise(c),
    }
    base = {"event_timestamp": F.col("event_timestamp").cast("date").cast("string")}
    return typed.select(
        *[
            faults.get(n, lambda c: c)(base.get(n, text(n))).alias(n)
            for n in names
        ]
    )


_RETAIL_NAMES = (
    "event_id transaction_id store_id store_city province store_region event_timestamp product_id "
    "product_name category quantity unit_price discount_amount final_price promotion_flag "
    "promotion_id payment_type loyalty_flag"
).split()


def retail_products(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Product dimension; with ``gaps`` it lacks every fiftieth part, for the checks of references."""
    part = table(spark, sf_dir, "part")
    return (part.filter("p_partkey % 50 <> 0") if gaps else part).select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(PRICE).alias("base_unit_price"),
    )


def retail_stores(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Store dimension; with ``gaps`` it lacks every seventh supplier."""
    supplier = table(spark, sf_dir, "supplier")
    supplier = supplier.filter("s_suppkey % 7 <> 0") if gaps else supplier
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.concat(F.lit("ST-"), F.col("s_suppkey").cast("string")).alias("store_id"),
            F.col("s_name").alias("store_city"),
            F.col("n_name").alias("province"),
            F.col("r_name").alias("store_region"),
        )
    )


def retail_promotions(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Promotion dimension: the promotions in use, with ``gaps`` except PR010; dates from the shipping window."""
    lines = table(spark, sf_dir, "lineitem").filter("l_discount >= 0.05")
    number = (F.col("l_discount") * 100).try_cast("decimal(6,0)")
    promotions = (
        lines.groupBy(number.cast("string").alias("number"))
        .agg(
            F.min("l_partkey").alias("part_key"),
            F.min("l_shipdate").cast("date").alias("start_date"),
            F.max("l_shipdate").cast("date").alias("end_date"),
        )
        .select(
            F.concat(F.lit("PR"), F.lpad("number", 3, "0")).alias("promotion_id"),
            F.concat(F.lit("P"), F.col("part_key").cast("string")).alias("product_id"),
            F.concat(F.lit("Discount "), F.col("number")).alias("promotion_name"),
            "start_date",
            "end_date",
            (F.col("number").cast("decimal(6,0)") / 100).cast("decimal(6,4)").alias("discount_rate"),
        )
    )
    return promotions.filter("promotion_id <> 'PR010'") if gaps else promotions


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label ``y`` and score ``p`` per order, with ties among the scores."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    y = (key % 5 == 0).cast("int")
    mix = ((key * 7919 + cust * 104729) % 10007) / F.lit(10007.0)
    return table(spark, sf_dir, "orders").select(
        key.alias("k"), y.alias("y"), (F.lit(0.6) * mix + F.lit(0.4) * y).alias("p")
    )
