from __future__ import annotations

from collections import Counter

import pytest
from corpus import frame, rows

import corpus_pipeline
from claimscale.llm import toxicity
from claimscale.llm.registered import LLM_QUERIES, toxicity_model
from claimscale.sources.staging import stage


def test_each_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))


def test_stages_in_order(spark, folder):
    """Each stage against what it must leave, on its own input."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    model = toxicity_model(docs, folder)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    left = []
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs, stage(function(spark, docs, folder), "test")
        left.append((name, before.count(), docs.count()))
        if name != "packing":
            assert docs.columns == columns
        if name == "toxicity":
            want = {i for i, s in scores.items() if s < toxicity.THRESHOLD}
            assert {r.doc_id for r in docs.collect()} == want
        if name == "exact_dedup":
            newest = {r.text: r.doc_id for r in before.orderBy("doc_id").collect()}
            assert {r.doc_id for r in docs.collect()} == set(newest.values())
        if name == "mixing":
            assert set(Counter(r.doc_id for r in docs.collect()).values()) <= {1, 2, 3}
    assert [n for n, *_ in left] == [n for n, _ in corpus_pipeline.STAGES]
    assert all(a > 0 and b > 0 for _, a, b in left)
    assert docs.agg({"length": "sum"}).first()[0] > 0


def test_stages_with_odd_rows(spark, folder):
    docs = stage(frame(spark, rows()))
    for _, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, folder), "odd")
    assert docs.count() > 0


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_queries_do_not_depend_on_partitions(spark, folder, name):
    if name in ("op7_language_id", "op9_packing"):
        pytest.skip("sums of floats and ranges follow the partitions")
    first = sorted(map(repr, LLM_QUERIES[name](spark, folder).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert sorted(map(repr, LLM_QUERIES[name](spark, folder).collect())) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
