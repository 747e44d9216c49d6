"""Hand-checked results on small fixed inputs."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import events, portfolio, quality
from tradeloom.schemas import RETAIL_EVENTS_RAW

# A small sample of transactions.
SAMPLE = """
TF-2026-0000001 GUARANTEE  JPY  629619.52  3 0 0 LOW
TF-2026-0000002 IMPORT_LC  CNY 1563233.52 14 1 1 MEDIUM
TF-2026-0000003 GUARANTEE  JPY 1545109.57  8 0 0 MEDIUM
TF-2026-0000004 COLLECTION CNY 1351414.55 12 0 1 MEDIUM
TF-2026-0000005 IMPORT_LC  CAD   71868.01 16 1 1 HIGH
TF-2026-0000006 IMPORT_LC  USD 1521482.60 11 1 1 MEDIUM
TF-2026-0000007 GUARANTEE  JPY  218534.52 13 0 1 MEDIUM
TF-2026-0000008 EXPORT_LC  CNY  408328.21 14 1 1 HIGH
TF-2026-0000009 IMPORT_LC  JPY  477790.11 13 0 1 HIGH
TF-2026-0000010 COLLECTION USD  236747.25 20 0 1 MEDIUM
TF-2026-0000011 IMPORT_LC  GBP  697112.64 15 1 1 HIGH
TF-2026-0000012 COLLECTION USD  253241.45 15 0 1 LOW
TF-2026-0000013 COLLECTION CAD  109282.55  7 0 0 MEDIUM
TF-2026-0000014 EXPORT_LC  GBP  302432.14 10 0 0 LOW
TF-2026-0000015 GUARANTEE  CNY 2039788.60  6 0 0 MEDIUM
TF-2026-0000016 IMPORT_LC  CNY  154771.67 14 0 1 MEDIUM
TF-2026-0000017 IMPORT_LC  EUR  343250.71 16 0 1 MEDIUM
TF-2026-0000018 IMPORT_LC  CAD  174904.62 10 0 0 MEDIUM
TF-2026-0000019 GUARANTEE  CNY  587349.15 13 0 1 HIGH
TF-2026-0000020 GUARANTEE  GBP  826500.61  4 0 0 LOW
"""


@pytest.fixture(scope="module")
def sample(spark):
    rows = []
    for line in SAMPLE.strip().splitlines():
        t, product, currency, amount, days, gap, late, rating = line.split()
        rows.append((t, product, currency, Decimal(amount), int(days), int(gap), int(late), rating))
    return spark.createDataFrame(
        rows,
        "transaction_id string, product_type string, currency string, amount decimal(18,2), "
        "processing_days int, discrepancy_flag int, delay_flag int, customer_risk_rating string",
    )


def test_risk_alerts(sample):
    alerts = events.high_risk_alerts(sample.withColumn("beneficiary_country", F.lit("US")))
    got = {r.transaction_id[-2:]: (r.risk_score, r.risk_reason) for r in alerts.collect()}
    large = (6, "Document discrepancy; Processing delay; Large transaction >= 1M")
    rated = (7, "High-risk customer; Document discrepancy; Processing delay")
    late = (5, "High-risk customer; Processing delay")
    assert got == {"02": large, "06": large, "05": rated, "08": rated, "11": rated, "09": late, "19": late}


def test_currency_kpis(sample):
    got = {
        r.currency: (
            r.unique_transactions,
            str(r.total_value),
            r.high_risk_transactions,
            r.discrepancy_transactions,
            r.delayed_transactions,
        )
        for r in events.currency_kpis(sample).collect()
    }
    assert got == {
        "CAD": (3, "356055.18", 1, 1, 1),
        "CNY": (6, "6104885.70", 2, 2, 5),
        "EUR": (1, "343250.71", 0, 0, 1),
        "GBP": (3, "1826045.39", 1, 1, 1),
        "JPY": (4, "2871053.72", 1, 0, 2),
        "USD": (3, "2011471.30", 0, 1, 3),
    }


def test_product_performance(sample):
    rows = portfolio.summarise(
        sample,
        ["product_type"],
        "transaction_count total_value_cad avg_processing_days discrepancy_rate delay_rate within_sla".split(),
    )
    got = {
        r.product_type: (
            r.transaction_count,
            round(float(r.total_value_cad), 2),
            round(r.avg_processing_days, 4),
            round(r.discrepancy_rate, 4),
            round(r.delay_rate, 4),
            r.within_sla,
        )
        for r in rows.collect()
    }
    assert got == {
        "COLLECTION": (4, 1032435.95, 13.5, 0.0, 0.75, 1),
        "EXPORT_LC": (2, 600789.96, 12.0, 0.5, 0.5, 1),
        "GUARANTEE": (6, 1951020.25, 7.8333, 0.0, 0.3333, 4),
        "IMPORT_LC": (8, 4360821.54, 13.625, 0.5, 0.875, 1),
    }


def test_unknown_currency_keeps_its_row(spark):
    rows = spark.createDataFrame(
        [("A", "XXX", Decimal("5.00")), ("A", "USD", Decimal("1.00"))],
        "product_type string, currency string, amount decimal(18,2)",
    )
    out = portfolio.summarise(
        rows, ["product_type"], ["transaction_count", "total_value_cad", "avg_transaction_value_cad"]
    ).first()
    assert (out[1], float(out[2]), out[3]) == (2, 1.36, 1.36)


def test_rates_relation_replaces_fixed_rates(sample, spark):
    rates = spark.createDataFrame([("USD", "2.0000")], "currency string, exchange_rate_to_cad string")
    from tradeloom.operators.valuation import fx_valuation

    valued = fx_valuation(sample, rates).filter("amount_cad is not null").agg(F.sum("amount_cad")).first()[0]
    assert float(valued) == pytest.approx(2 * 2011471.30)
    assert fx_valuation(sample, rates).count() == 20


def retail_row(spark, **changes):
    base = dict(
        event_id="E1", transaction_id="T1", store_id="S1", store_city="City", province="Ontario",
        store_region="Central", event_timestamp="2026-07-20 12:00:00", product_id="P001",
        product_name="Milk", category="Dairy", quantity="1", unit_price="2.50", discount_amount="0",
        final_price="2.50", promotion_flag="N", promotion_id=None, payment_type="Cash", loyalty_flag="Y",
    )
    return spark.createDataFrame([tuple({**base, **changes}.values())], RETAIL_EVENTS_RAW)


def test_quarantine_reasons_of_malformed_rows(spark):
    first = retail_row(
        spark, event_id="BAD-1", transaction_id=None, event_timestamp="not-a-date", quantity="two",
        unit_price="6.49", final_price="6.49",
    )
    second = retail_row(
        spark, event_id="BAD-2", store_id="UNKNOWN", product_id="P999", quantity="-1", unit_price="-5.0",
        final_price="-5.0",
    )
    got = {r.event_id: r.rejection_reason for r in quality.quarantine_reasons(first.union(second)).collect()}
    assert got == {
        "BAD-1": "Missing transaction_id; Invalid event_timestamp; Invalid quantity",
        "BAD-2": "Invalid quantity; Invalid unit_price; Invalid final_price",
    }


@pytest.mark.parametrize(
    "changes, valid",
    [
        ({}, True),
        ({"loyalty_flag": "Y\r"}, True),
        ({"quantity": " 7 "}, True),
        ({"quantity": "40000"}, False),
        ({"quantity": "0"}, False),
        ({"quantity": "2.5"}, False),
        ({"unit_price": "0"}, False),
        ({"discount_amount": "-0.01"}, False),
        ({"final_price": "0"}, True),
        ({"promotion_flag": "Y"}, False),
        ({"promotion_flag": "Y", "promotion_id": "PR001"}, True),
        ({"promotion_flag": "N", "promotion_id": "PR001"}, False),
        ({"promotion_flag": None}, False),
        ({"loyalty_flag": "X"}, False),
        ({"transaction_id": "  "}, False),
        ({"event_timestamp": "2026-02-30"}, False),
    ],
)
def test_sale_line_validity(spark, changes, valid):
    assert quality.typed_retail_events(retail_row(spark, **changes)).count() == int(valid)


def test_large_quantity_is_invalid_for_the_load_only(spark):
    row = quality.quarantine_reasons(retail_row(spark, quantity="40000")).first()
    assert row.rejection_reason == quality.QUARANTINE_FALLBACK


def test_fail_fast_gate_code(spark):
    with pytest.raises(quality.LoadRejected) as stop:
        quality.fail_fast_gate(retail_row(spark, quantity="two"), "RetailEvents")
    assert stop.value.code == 50004
    assert quality.fail_fast_gate(retail_row(spark), "RetailEvents").count() == 1


def test_expected_counts_stop_at_lowest_code(spark):
    counts = spark.createDataFrame(
        [("Products", 45), ("Stores", 11), ("Promotions", 7)], "table_name string, record_count long"
    )
    with pytest.raises(quality.LoadRejected) as stop:
        quality.require_expected_counts(counts)
    assert stop.value.code == 51002


def test_orphan_gate_code(spark):
    facts = retail_row(spark)
    known = spark.createDataFrame([("P001",)], "product_id string")
    quality.require_no_orphans(facts, {"product_id": known})
    stores = spark.createDataFrame([("S2",)], "store_id string")
    with pytest.raises(quality.LoadRejected) as stop:
        quality.require_no_orphans(facts, {"product_id": known, "store_id": stores})
    assert stop.value.code == 51008


def test_invalid_transactions_raise(spark, sample):
    with pytest.raises(ValueError, match="missing columns"):
        quality.transaction_validation(sample)


def test_price_and_promotion_rules(spark):
    prices = spark.createDataFrame([(Decimal("0.00"),), (Decimal("1.00"),)], "base_unit_price decimal(12,2)")
    assert quality.rule_violations(prices, quality.price_rules()).first()["violations"] == 1
    promos = spark.sql(
        "SELECT date'2026-01-02' AS start_date, date'2026-01-01' AS end_date, 1.5BD AS discount_rate"
    )
    got = {r[0]: r[1] for r in quality.rule_violations(promos, quality.promotion_table_rules()).collect()}
    assert got == {"date_range": 1, "discount_rate_range": 1}


def test_event_order_is_total(spark):
    rows = spark.range(500).selectExpr(
        "CAST(id AS STRING) AS event_id", "lpad(CAST((id * 37) % 50 AS STRING), 3, '0') AS event_time"
    )
    got = [(r.event_time, r.event_id) for r in events.event_time_order(rows.repartition(5)).collect()]
    assert got == sorted(got) and len(got) == 500
