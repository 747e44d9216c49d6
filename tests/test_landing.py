"""What is landed once for many queries."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.rows import frame_rows
from tradeloom.plans.driver_tables import event_log, landed_log, retail_events, table


def test_the_landed_log_is_whole_and_small(spark, sf_dir, tmp_path):
    def size(folder):
        return sum(e.stat().st_size for e in os.scandir(folder.removeprefix("file:")) if e.name.endswith(".parquet"))

    rows = event_log(table(spark, sf_dir, "events"))
    plain = str(tmp_path / "plain")
    rows.write.parquet(plain)
    landed = landed_log(spark, sf_dir)
    assert spark.read.parquet(landed).exceptAll(rows).isEmpty() and spark.read.parquet(landed).count() == rows.count()
    assert size(landed) < 0.75 * size(plain)


def test_staged_lines_are_read_without_a_copy_of_them(spark, sf_dir, monkeypatch):
    monkeypatch.setattr("tradeloom.plans.driver_tables.landed", lambda *_: pytest.fail("a copy was written"))
    gates = entry.queries()["fail_fast_gate"](spark, sf_dir).collect()
    assert {(g.table_name, g.stopped, g.code) for g in gates} == {
        ("Products", True, 50001), ("RetailEvents", True, 50004), ("Stores", False, 0)
    }


def test_a_single_invalid_line_at_the_end_stops_the_load(spark, sf_dir, tmp_path):
    # Only the last line of the table has a part whose key plants a fault.
    lines = table(spark, sf_dir, "lineitem").withColumn("l_partkey", F.lit(1).cast("long"))
    last = lines.agg(F.max(F.struct("l_orderkey", "l_linenumber"))).first()[0]
    is_last = (F.col("l_orderkey") == last[0]) & (F.col("l_linenumber") == last[1])
    for folder, part in (("good", 1), ("bad", 97)):
        for name in ("part", "supplier", "nation", "region", "orders"):
            table(spark, sf_dir, name).write.parquet(f"{tmp_path}/{folder}/{name}.parquet")
        changed = lines.withColumn("l_partkey", F.when(is_last, part).otherwise(F.col("l_partkey")).cast("long"))
        changed.orderBy("l_orderkey", "l_linenumber").write.parquet(f"{tmp_path}/{folder}/lineitem.parquet")
    stopped = {
        folder: {g.table_name: g.code for g in entry.queries()["fail_fast_gate"](spark, f"{tmp_path}/{folder}").collect()}
        for folder in ("good", "bad")
    }
    assert (stopped["good"]["RetailEvents"], stopped["bad"]["RetailEvents"]) == (0, 50004)


def test_lines_are_narrow_where_large_tables_are_joined(spark, sf_dir):
    # At size the joins with orders and parts shuffle; names of stores and regions must not go through them.
    rows = retail_events(spark, sf_dir)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if " Join " in line or line.startswith("Join ")]
    keys = [next(k for k in ("o_orderkey", "p_partkey", "s_suppkey", "n_nationkey", "r_regionkey") if k in j) for j in joins]
    # The plan is printed from its last join to its first.
    assert keys == ["r_regionkey", "n_nationkey", "s_suppkey", "p_partkey", "o_orderkey"]
    assert rows.count() == table(spark, sf_dir, "lineitem").count()


def test_lines_are_staged_as_csv_in_one_pass(spark, sf_dir, monkeypatch):
    monkeypatch.setattr("tradeloom.plans.driver_tables.landed", lambda *_: pytest.fail("a copy was written"))
    staged = entry.queries()["csv_staging_scan"](spark, sf_dir)
    assert staged.count() == table(spark, sf_dir, "lineitem").count()


@pytest.mark.parametrize("name", ["cell_versions", "latest_state_by_key"])
def test_a_batch_query_reads_the_log_without_a_copy_of_it(spark, sf_dir, monkeypatch, name):
    want = frame_rows(entry.queries()[name](spark, sf_dir))
    monkeypatch.setattr("tradeloom.plans.driver_tables.landed", lambda *_: pytest.fail("a copy was written"))
    monkeypatch.setattr("tradeloom.plans.queries_events.landed_log", lambda *_: pytest.fail("a copy was written"))
    assert frame_rows(entry.queries()[name](spark, sf_dir)) == want
