"""The stages in a row, against plain versions."""

from collections import Counter

import corpus_pipeline
from tests.llm.test_brute_force import plain_components
from tradeloom.llm import mixing, toxicity


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]


def test_run_equals_plain_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = {r.doc_id: r for r in docs.collect() if model.exceed(r.text)[0] < 0.5}
    last = {}
    for i in sorted(kept):
        last[kept[i].text] = i
    kept = {i: kept[i] for i in last.values()}
    top = plain_components({i: r.text for i, r in kept.items()}, 5, 80)
    kept = [r for i, r in kept.items() if top[i] == i]
    mixed = mixing.mix(spark.createDataFrame(kept, docs.schema))
    want = Counter(r.doc_id for r in mixed.collect())
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(p.doc_id for p in pieces if p.start == 0) == want
    whole = Counter()
    for p in pieces:
        assert p.length == len(p.ids)
        whole[p.doc_id] += p.length
    tokens = {p.doc_id: p.doc_tokens for p in pieces}
    assert whole == Counter({i: n * tokens[i] for i, n in want.items()})
