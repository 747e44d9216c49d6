"""Values beyond the usual ranges are neither cut nor dropped."""

from pyspark.sql import functions as F

from tradeloom.operators import portfolio, quality
from tradeloom.sources.external import kafka_options


def test_huge_amounts_count(spark):
    line = '{{"product_type":"P","beneficiary_country":"C","currency":"CAD","amount":{}}}'
    lines = spark.createDataFrame([(line.format("1e21"),), (line.format("5.5"),), (line.format('"x"'),)], "value string")
    counts = portfolio.mapper_validation(lines).first()
    assert (counts.valid_rows, counts.invalid_rows) == (2, 1)
    total = portfolio.volume_by_product_country_currency(lines).first()
    assert (total.transaction_count, float(total.total_value)) == (2, 1e21 + 5.5)


def test_long_text_stays_whole_unless_widths_are_given(spark):
    long = "x" * 150
    staged = spark.createDataFrame(
        [("P1", long, "c" * 60, "1.50")], "product_id string, product_name string, category string, base_unit_price string"
    )
    whole = quality.typed_products(staged).first()
    assert (whole.product_name, whole.category) == (long, "c" * 60)
    cut = quality.typed_products(staged, quality.TARGET_WIDTHS).first()
    assert (cut.product_name, cut.category) == (long[:100], "c" * 30)


def test_audit_has_a_row_for_every_key(spark):
    facts = spark.createDataFrame([("a", None), ("z", None)], "k1 string, k2 string")
    known = spark.createDataFrame([("a",)], "id string")
    keys = {"k1": (known, "id"), "k2": (known, "id")}
    got = {r.column_name: r.violations for r in quality.foreign_key_audit(facts, keys, "t").collect()}
    assert got == {"k1": 1, "k2": 0}
    empty = facts.where(F.lit(False))
    assert {r.violations for r in quality.foreign_key_audit(empty, keys, "t").collect()} == {0}


def test_rate_limits_are_a_parameter():
    assert kafka_options("s", "events")["maxOffsetsPerTrigger"] == "20"
    assert "maxOffsetsPerTrigger" not in kafka_options("s", "events", limits={})
