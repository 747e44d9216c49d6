"""Record layouts and fixed values shared by the batch and streaming jobs."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
PRICE = T.DecimalType(12, 2)
RATE = T.DecimalType(5, 4)
DISCOUNT_RATE = T.DecimalType(6, 4)


def _struct(*groups: tuple[T.DataType, str]) -> T.StructType:
    """Nullable struct from (type, "name name name") groups, in the given order."""
    return T.StructType(
        [T.StructField(name, dtype, True) for dtype, names in groups for name in names.split()]
    )


TRANSACTION = _struct(
    (T.StringType(), "transaction_id product_type applicant_id beneficiary_id"),
    (T.StringType(), "applicant_country beneficiary_country currency"),
    (MONEY, "amount"),
    (T.StringType(), "issue_date expiry_date status goods_category"),
    (T.IntegerType(), "amendment_count document_count processing_days"),
    (T.IntegerType(), "discrepancy_flag delay_flag counterparty_relationship_years"),
    (T.StringType(), "customer_risk_rating"),
)

# One payload layout for every event type: transaction fields, screening outcomes, and the
# document and rate fields that the keyed projections need. Absent fields read as null.
PAYLOAD = T.StructType(
    TRANSACTION.fields
    + _struct(
        (T.StringType(), "result risk_rating document_type base_currency quote_currency"),
        (T.DecimalType(18, 6), "rate"),
    ).fields
)

ENVELOPE = T.StructType(
    _struct(
        (T.StringType(), "event_id event_type event_time source aggregate_type aggregate_id"),
        (T.StringType(), "transaction_id schema_version"),
    ).fields
    + [T.StructField("payload", PAYLOAD, True)]
)

KAFKA_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

PRODUCTS_RAW = _struct((T.StringType(), "product_id product_name category base_unit_price"))
STORES_RAW = _struct((T.StringType(), "store_id store_city province store_region"))
PROMOTIONS_RAW = _struct(
    (T.StringType(), "promotion_id product_id promotion_name start_date end_date discount_rate")
)
RETAIL_EVENTS_RAW = _struct(
    (T.StringType(), "event_id transaction_id store_id store_city province store_region"),
    (T.StringType(), "event_timestamp product_id product_name category quantity unit_price"),
    (T.StringType(), "discount_amount final_price promotion_flag promotion_id"),
    (T.StringType(), "payment_type loyalty_flag"),
)
DATA_DICTIONARY_RAW = _struct((T.StringType(), "field_name generated_dtype dataset"))

# --- Fixed values -----------------------------------------------------------------------------

# CAD value of one unit of each currency.
CAD_RATES = {
    "CAD": "1.0000",
    "USD": "1.3600",
    "EUR": "1.4800",
    "GBP": "1.7300",
    "JPY": "0.0092",
    "CNY": "0.1900",
}

# Event families and the topics they travel on.
TOPIC_FAMILIES = (
    "lc",
    "guarantee",
    "collection",
    "payment",
    "document",
    "shipment",
    "compliance",
    "sanctions",
    "limit",
    "fx",
)
DEAD_LETTER_TOPIC = "tf.dlq.events"
RESULT_TOPICS = {
    "transaction_anomaly": "tf.ml.anomaly-results",
    "document_discrepancy": "tf.ml.discrepancy-results",
    "processing_delay": "tf.ml.delay-results",
    "trade_volume_forecast": "tf.ml.forecast-results",
}

# Event-type prefixes per family, in matching order.
ROUTE_PREFIXES = {
    "lc": ("LC_",),
    "guarantee": ("GUARANTEE_",),
    "collection": ("COLLECTION_",),
    "payment": ("PAYMENT_",),
    "document": ("DOCUMENT", "DISCREPANCY"),
    "shipment": ("SHIPMENT_",),
    "compliance": ("COMPLIANCE_",),
    "sanctions": ("SANCTIONS_",),
    "limit": ("LIMIT_",),
    "fx": ("FX_",),
}

# Wide string store: column -> family:qualifier cell.
TRANSACTION_CELLS = {
    "product_type": "instrument:product_type",
    "status": "instrument:status",
    "issue_date": "instrument:issue_date",
    "expiry_date": "instrument:expiry_date",
    "currency": "financial:currency",
    "amount": "financial:amount",
    "applicant_id": "parties:applicant_id",
    "beneficiary_id": "parties:beneficiary_id",
    "applicant_country": "geography:applicant_country",
    "beneficiary_country": "geography:beneficiary_country",
    "goods_category": "trade:goods_category",
    "amendment_count": "metrics:amendment_count",
    "document_count": "metrics:document_count",
    "processing_days": "metrics:processing_days",
    "discrepancy_flag": "metrics:discrepancy_flag",
    "delay_flag": "metrics:delay_flag",
    "counterparty_relationship_years": "metrics:counterparty_relationship_years",
    "customer_risk_rating": "risk:customer_risk_rating",
}
RESULT_CELLS = {
    "model_name": "model:name",
    "model_version": "model:version",
    "anomaly_score": "prediction:score",
    "risk_class": "prediction:class",
    "probability": "prediction:probability",
    "expected_days": "prediction:expected_days",
    "forecast_month": "prediction:forecast_month",
    "predicted_transactions": "prediction:predicted_transactions",
    "prediction_timestamp": "audit:prediction_timestamp",
}

SLA_DAYS = 10
LARGE_AMOUNT = 1_000_000
CELL_VERSIONS = 3

# Lookup values that a retail load starts from.
RETAIL_LOOKUPS = {
    "category": (
        "Bakery",
        "Dairy",
        "Frozen",
        "Grocery",
        "Household",
        "Meat",
        "Personal Care",
        "Produce",
    ),
    "province": ("Alberta", "Ontario"),
    "store_region": ("Central", "Eastern", "Western"),
    "payment_type": ("Cash", "Credit", "Debit", "Mobile"),
}

# Row counts and error codes of the retail acceptance check.
EXPECTED_COUNTS = {
    "Products": (45, 51001),
    "Stores": (12, 51002),
    "Promotions": (8, 51003),
    "RetailEvents": (38143, 51004),
    "SourceDataDictionary": (18, 51005),
    "RejectedRetailEvents": (2, 51006),
}
LOAD_ERROR_CODES = {"Products": 50001, "Stores": 50002, "Promotions": 50003, "RetailEvents": 50004}
ORPHAN_ERROR_CODES = {"product_id": 51007, "store_id": 51008, "promotion_id": 51009}


def topic_of(family: str) -> str:
    return f"tf.{family}.events"


def topic_pattern(families=TOPIC_FAMILIES) -> str:
    return rf"tf\.({'|'.join(families)})\.events"


INPUT_TOPICS = tuple(topic_of(f) for f in TOPIC_FAMILIES)
