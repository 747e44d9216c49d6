"""Plans keep their shape: pruned scans, single parses, limited windows, no all-pairs joins."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.rows import frame_rows
from tradeloom.operators import export, state
from tradeloom.plans.driver_tables import transactions

JOINING = "risk_summary store_sales_summary orphan_stores foreign_key_audit average_percentile_rank".split()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def details_of(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_scan_reads_only_named_columns(spark, sf_dir):
    plan = plan_of(entry.queries()["portfolio_totals"](spark, sf_dir))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "Join" not in plan


@pytest.mark.parametrize("name", ["latest_state_by_key", "high_risk_alerts", "cell_versions"])
def test_envelopes_are_parsed_once(spark, sf_dir, name):
    assert plan_of(entry.queries()[name](spark, sf_dir)).count("from_json(") == 1


def test_group_limit_runs_before_the_shuffle(spark, sf_dir):
    plan = plan_of(entry.queries()["cell_versions"](spark, sf_dir))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(entry.queries()["top_country_exposure"](spark, sf_dir))


CHEAP_PLANS = [
    n
    for n in entry.oracle_sql()
    if not any(w in n for w in ("stream", "sink", "scan", "jsonl", "export", "bi_", "publish", "upsert"))
    and n not in ("rate_limit", "at_least_once_commit", "poison_isolation", "model_summary", "zone_landing")
]


@pytest.mark.parametrize("name", CHEAP_PLANS)
def test_no_all_pairs_join(spark, sf_dir, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", JOINING)
def test_same_rows_when_nothing_is_broadcast(spark, sf_dir, name):
    want = frame_rows(entry.queries()[name](spark, sf_dir))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert frame_rows(entry.queries()[name](spark, sf_dir)) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_key_lookup_reaches_the_files(spark, sf_dir, tmp_path):
    store = export.bulk_load(transactions(spark, sf_dir), str(tmp_path / "store"), "test")
    key = store.agg(F.max(":key")).first()[0]
    found = state.point_lookup(store, key, ":key")
    assert found.count() == 1
    assert f"EqualTo(`:key`,{key})" in details_of(found)
    prefix = state.prefix_scan(store, "TF-1998", 5, ":key")
    assert "StringStartsWith(`:key`,TF-1998)" in details_of(prefix) and prefix.count() == 5
    assert {r["audit:load_source"] for r in store.limit(3).collect()} == {"test"}


def test_bulk_load_needs_keys(spark, sf_dir, tmp_path):
    rows = transactions(spark, sf_dir).limit(5).withColumn("transaction_id", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="missing transaction_id"):
        export.bulk_load(rows, str(tmp_path / "store"), "test")


def test_lookups_push_the_key_to_the_sorted_store(spark, sf_dir, tmp_path):
    store = export.bulk_load(transactions(spark, sf_dir), str(tmp_path / "store"), "test")
    key = store.agg(F.max(":key")).first()[0]
    for found in (state.point_lookup(store, key, ":key"), state.prefix_scan(store, key[:7], 3, ":key")):
        pushed = found._jdf.queryExecution().executedPlan().toString().split("PushedFilters: [")[1].split("]")[0]
        assert "EqualTo(" in pushed or "StringStartsWith(" in pushed, pushed
    assert state.point_lookup(store, key, ":key").count() == 1
