"""Every query with SQL gives the rows that DuckDB gives for it."""

import pytest

import __spark_entry__ as entry
from tests.rows import rows_by_name

# Checked by invariants in test_models.py, where smaller models do.
MODELS = {
    "discrepancy_classifier",
    "discrepancy_classifier_tuned",
    "delay_classifier",
    "delay_regressor",
    "periodic_rescore",
    "isolation_forest_score",
}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(name, spark, sf_dir, duck):
    df = entry.queries()[name](spark, sf_dir)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    got = rows_by_name(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows_by_name(names, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - MODELS))
def test_runs(name, spark, sf_dir):
    assert entry.queries()[name](spark, sf_dir).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark, sf_dir):
    rows = entry.entry(spark).collect()
    assert len(rows) == 4
