"""The retail load: published whole, or not at all."""

import pytest
from tests.test_goldens import retail_row

from tradeloom.operators import load, quality
from tradeloom.schemas import RETAIL_EVENTS_RAW

PRODUCT = "product_id string, product_name string, category string, base_unit_price string"
STORE = "store_id string, store_city string, province string, store_region string"
PROMOTION = "promotion_id string, product_id string, promotion_name string, start_date string, end_date string, discount_rate string"


def staged(spark, **changes):
    return {
        "Products": spark.createDataFrame([("P001", "Milk", "Dairy", "2.50\r")], PRODUCT),
        "Stores": spark.createDataFrame([("S1", "City", "Ontario", "Central")], STORE),
        "Promotions": spark.createDataFrame([("PR1", "P001", "Half", "2026-01-01", "2026-02-01", "0.5")], PROMOTION),
        "RetailEvents": retail_row(spark, **changes),
    }


@pytest.mark.parametrize(
    ("changes", "code"),
    [
        ({"quantity": "two"}, 50004),
        ({"product_id": "P999"}, 51007),
        ({"store_id": "S9"}, 51008),
        ({"promotion_flag": "Y", "promotion_id": "PR9"}, 51009),
    ],
)
def test_a_stopped_load_shows_nothing_and_leaves_the_last_one(spark, tmp_path, changes, code):
    base = str(tmp_path)
    for published in (None, load.retail_load(staged(spark), f"{base}/b")):
        place = f"{base}/{'a' if published is None else 'b'}"
        with pytest.raises(quality.LoadRejected) as stop:
            load.retail_load(staged(spark, **changes), place)
        assert stop.value.code == code
        assert load.published_version(spark, place) == published
    assert load.published_table(spark, f"{base}/a", "Products") is None
    row = load.published_table(spark, f"{base}/b", "RetailEvents").first()
    assert (row.product_id, row.quantity, str(row.final_price)) == ("P001", 1, "2.50")


def test_first_failing_check_in_load_order_counts(spark, tmp_path):
    tables = staged(spark, quantity="two") | {"Stores": spark.createDataFrame([("S1", " ", "Ontario", "Central")], STORE)}
    with pytest.raises(quality.LoadRejected) as stop:
        load.retail_load(tables, str(tmp_path))
    assert stop.value.code == 50002


def test_expected_counts_and_other_tables(spark, tmp_path):
    base, lookup = str(tmp_path), spark.createDataFrame([("Cash",)], "payment_type string")
    with pytest.raises(quality.LoadRejected) as stop:
        load.retail_load(staged(spark), base, {"PaymentTypes": lookup}, {"PaymentTypes": (2, 51005), "Stores": (2, 51002)})
    assert stop.value.code == 51002
    first = load.retail_load(staged(spark), base, {"PaymentTypes": lookup}, {"PaymentTypes": (1, 51005)})
    second = load.retail_load(staged(spark, quantity="3"), base, {"PaymentTypes": lookup})
    assert first < second == load.published_version(spark, base)
    assert load.published_table(spark, base, "RetailEvents").first().quantity == 3
    assert load.published_table(spark, base, "PaymentTypes").count() == 1


def test_no_lines(spark, tmp_path):
    empty = staged(spark) | {"RetailEvents": spark.createDataFrame([], RETAIL_EVENTS_RAW)}
    load.retail_load(empty, str(tmp_path))
    assert load.published_table(spark, str(tmp_path), "RetailEvents").count() == 0
