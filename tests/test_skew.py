"""One key holds a third or more of all rows: results stay whole and exact."""

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import quality, retail, state
from tradeloom.operators.events import ARRIVAL, first_arrivals
from tradeloom.plans.driver_tables import event_log
from tradeloom.sources.files import file_event_source
from tradeloom.streaming import jobs, sinks

N = 30_000
HOT = N // 3


@pytest.fixture(scope="module")
def flat(spark):
    """Events of which a third belong to one transaction, in no particular order."""
    return spark.range(N).selectExpr(
        f"CASE WHEN id < {HOT} THEN 'TF-HOT' ELSE concat('TF-', id % 997) END AS transaction_id",
        "lpad(CAST((id * 7919) % 30011 AS STRING), 6, '0') AS event_time",
        "CAST(id AS STRING) AS event_id",
        "CAST(id % 50 AS DECIMAL(18,2)) AS amount",
        "timestamp_seconds((id * 7919) % 30011) AS kafka_timestamp",
        "concat('t', id % 3) AS topic",
        "CAST(id % 5 AS INT) AS partition",
        "id AS offset",
    ).repartition(6)


def test_first_arrival_of_a_hot_key(flat):
    got = first_arrivals(flat)
    assert got.count() == flat.select("transaction_id").distinct().count()
    want = flat.filter("transaction_id = 'TF-HOT'").orderBy(*ARRIVAL).first()
    assert got.filter("transaction_id = 'TF-HOT'").first()["event_id"] == want["event_id"]


def test_newest_rows_of_a_hot_key(flat):
    order = [F.desc("event_time"), F.desc("event_id")]
    got = state.ranked_rows(flat, ["transaction_id"], order, 3).filter("transaction_id = 'TF-HOT'")
    want = flat.filter("transaction_id = 'TF-HOT'").orderBy(*order).limit(3)
    assert {r.event_id for r in got.collect()} == {r.event_id for r in want.collect()}


def test_hot_store_counts_all_its_transactions(spark):
    sales = spark.range(N).selectExpr(
        f"CASE WHEN id < {HOT} THEN 'ST-HOT' ELSE concat('ST-', id % 10) END AS store_id",
        "'c' AS store_city", "'p' AS province", "'r' AS store_region", "concat('T', id % 5000) AS transaction_id",
        "CAST(1 AS SMALLINT) AS quantity", "CAST(1.25 AS DECIMAL(12,2)) AS final_price",
    )
    hot = retail.store_sales_summary(sales).filter("store_id = 'ST-HOT'").first()
    assert (hot.product_sale_events, hot.transaction_count, hot.units_sold) == (HOT, 5000, HOT)
    assert float(hot.total_sales) == HOT * 1.25


def test_hot_orphan_keeps_every_row(spark):
    facts = spark.range(N).selectExpr(f"IF(id < {HOT}, 'X', concat('P', id % 10)) AS product_id", "id")
    known = spark.range(10).selectExpr("concat('P', id) AS product_id")
    assert quality.orphans(facts, known, "product_id").count() == HOT


def test_stream_dedupe_of_a_hot_key_keeps_the_first_arrival(spark, tmp_path):
    """Four files, one per micro-batch; every event of a transaction differs, and which one wins counts."""
    events = spark.range(4_000).selectExpr(
        "id AS event_id", "CAST(timestamp_seconds(id DIV 2) AS TIMESTAMP) AS ts",
        "IF(id % 3 = 0, 7, id % 200) AS user_id", "'click' AS event_type",
    )
    log = event_log(events)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    log.repartitionByRange(4, F.desc("timestamp")).write.parquet(source)
    stream = file_event_source(spark, source, max_files=1)
    jobs.stream_dedupe(stream, out, str(tmp_path / "cp")).awaitTermination()
    rows = jobs.arriving_transactions(log)
    assert sinks.read_batches(spark, out, rows.schema).select("batch_id").distinct().count() == 4
    got = {r.transaction_id: r.event_id for r in jobs.read_first_arrivals(spark, out, rows.schema).collect()}
    want = {}
    for r in rows.orderBy(*ARRIVAL).collect():
        want.setdefault(r.transaction_id, r.event_id)
    assert got == want and len(got) > 100
