"""Every operator and stage takes nulls, empty and very long texts, repeated rows, empty tables, and
columns with the operators' own names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import SCHEMA, odd_rows
from tradeloom.llm import (
    exact_dedup,
    line_dedup,
    lm,
    mixing,
    near_dedup,
    packing,
    quality,
    secret_scan,
    toxicity,
    url_filter,
)

LABELS = "doc_id long, quality int, toxic int, id long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0, 9), (7, 0, 1, 9), (7, 0, 1, 9), (8, None, None, 9), (None, 1, 1, 9)], LABELS)


def scored(docs):
    counted = lm.blocks(docs, "doc_id", "text")
    return lm.score(lm.fit(counted), counted)


PER_DOCUMENT = {
    "lm": lambda docs, labels: scored(docs),
    "exact": lambda docs, labels: exact_dedup.decide(docs),
    "quality": lambda docs, labels: quality.decide(docs, labels),
    "secrets": lambda docs, labels: secret_scan.find(docs, secret_scan.fit(secret_scan.labelled_samples(docs))),
    "toxicity": lambda docs, labels: toxicity.judge(docs, toxicity.fit(docs, labels)),
    "near": lambda docs, labels: near_dedup.decide(docs, 3, 85),
    "lines": lambda docs, labels: line_dedup.dedup(docs, min_documents=2),
}


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_document(docs, labels, name):
    rows = PER_DOCUMENT[name](docs, labels).collect()
    key = "id"
    assert sorted(str(r[key]) for r in rows) == sorted(str(r.doc_id) for r in docs.collect())


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_empty_table(docs, labels, name):
    assert PER_DOCUMENT[name](docs.where(F.lit(False)), labels.where(F.lit(False))).count() == 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_the_columns(spark, docs, labels, stage, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    out = stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in docs.collect()}
    assert stage(spark, docs.where(F.lit(False)), str(tmp_path)).count() == 0


def test_repeated_rows_come_out_once_where_copies_go(docs):
    ids = [r.doc_id for r in exact_dedup.dedup(docs).collect()]
    assert sorted(map(str, ids)) == sorted(map(str, [2, 4, 5, 6, 7, 8, 9, 10, None, 11]))
    near = [r.doc_id for r in near_dedup.dedup(docs, 3, 80).collect()]
    assert near.count(1) == 1 and 2 not in near and 7 not in near and {4, 5, 6, 9, 10, 11} <= set(near)


def test_packing_and_mixing(spark, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(docs, path, 2, 64).collect()
    assert sum(len(p.ids) for p in pieces if p.id in (3, 4, 5)) == 3
    assert packing.pack(docs.where(F.lit(False)), path, 2).count() == 0
    mixed = mixing.mix(docs, epochs=5.0)
    assert mixed.columns == [*docs.columns, "n_copies", "copy", "shuffle_key"]
    assert {None, "a", "b"} == {r.source for r in mixed.collect()}
    assert mixing.mix(docs.where(F.lit(False))).count() == 0


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, None, "h", "v"), (2, "no scheme", "h", "v"), (None, "http://A.Net/es/x?y", "h", "v"), (4, "x://net#/es/", "h", "v"),
         (5, "http://net/es/" + "a" * 100_000, "h", "v"), (5, "http://net/es/" + "a" * 100_000, "h", "v")],
        "page_id long, url string, host string, verdict string",
    )
    rules = spark.createDataFrame([("net", "/es/", "allow"), ("NET", "/es/", "block")], "host string, path string, verdict string")
    got = sorted((str(r.id), r.host, r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect())
    assert got == [
        ("1", "", None, "allow"), ("2", "", None, "allow"), ("4", "net", None, "allow"),
        ("5", "net", "net/es/", "block"), ("5", "net", "net/es/", "block"), ("None", "a.net", "net/es/", "block"),
    ]
    assert url_filter.judge(pages, rules.where(F.lit(False)), default="block").where("verdict = 'block'").count() == 6
    assert url_filter.judge(pages.where(F.lit(False)), rules).count() == 0
