"""From files to the comparison, with every table in between."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimscale.plans import news, standins, workflow
from claimscale.sources import files, tables
from claimscale.sources.staging import fresh_path


@pytest.fixture(scope="module")
def schema(spark):
    return tables.fresh_schema(spark)


def test_whole_workflow(spark, folder, schema):
    documents = standins.table(spark, folder, "documents")
    docs, model = fresh_path(spark, "docs"), fresh_path(spark, "model")
    key = files.write_document_files(documents, "doc_id", "text", docs)
    metadata = documents.select(
        F.col("doc_id").cast("string").alias("ticker"),
        F.col("source").alias("organisation"),
        F.col("lang").alias("description"),
    )
    raw = workflow.ingest_documents(
        spark, docs, metadata, schema, fresh_path(spark, "checkpoint"), key, "*.txt"
    )
    assert raw.count() == documents.count()

    statements = workflow.build_statements(spark, schema, min_chars=100)
    assert statements.count() > 0
    assert statements.filter(F.length("statement") < 100).count() == 0

    fixed_rule = statements.count()
    learned = workflow.build_statements(spark, schema, min_chars=100, learned=True)
    assert 0 < learned.count() and abs(learned.count() - fixed_rule) < fixed_rule / 2

    workflow.train(spark, schema, model, passes=3)
    talk = workflow.build_disclosure_scores(spark, schema, model, min_probability=0.3)
    assert talk.filter("score <= 0 or score > 100").count() == 0
    chosen = spark.table(f"{schema}.{workflow.INITIATIVES}")
    assert chosen.count() == chosen.select("organisation", "topic_id").distinct().count()

    articles = (
        standins.table(spark, folder, "pages")
        .join(metadata, F.col("page_id").cast("string") == F.col("ticker"))
        .select(
            F.current_date().alias("date"),
            F.upper("organisation").alias("organisation"),
            "url",
            (F.col("page_id") % 20 - 10.0).alias("tone"),
            F.col("html").alias("title"),
        )
    )
    walk = workflow.build_news_scores(spark, articles, schema, model)
    organisations = articles.select("organisation").distinct().count()
    assert walk.count() == organisations * 5

    compared = workflow.comparison(spark, schema).collect()
    assert compared
    gaps = [r["walk"] - r["talk"] for r in compared]
    assert gaps == sorted(gaps, reverse=True)


def test_prepared_news(spark):
    def article(day, ticker, url, page, themes=("UNGP_X",)):
        return (day, ticker, list(themes), page, url, (1.5, 2.0), "src")

    titled = "<PAGE_TITLE>T</PAGE_TITLE>"
    raw = spark.createDataFrame(
        [
            *[article(d, "A", f"u{d}", titled) for d in range(150)],
            *[article(149, "A", "u149", titled)] * 500,
            article(1, "B", "u", titled, ("OTHER",)),
            article(1, "B", "u", "<x/>"),
            article(1, "B", "u", None),
            article(1, "Z", "u", titled),
            article(5, "B", "v", titled),
        ],
        "publishDate int, ticker string, themes array<string>, extrasXML string, "
        "documentIdentifier string, tone struct<tone: double, other: double>, "
        "sourceCommonName string",
    )
    orgs = spark.createDataFrame([("A", "a"), ("B", "b")], "ticker string, organisation string")
    got = news.prepare_news(raw, orgs).collect()
    a = sorted((r["rank"], r["date"]) for r in got if r["ticker"] == "A")
    assert a == [(i, 150 - i) for i in range(1, 100)]
    assert [(r["date"], r["tone"], r["rank"]) for r in got if r["ticker"] == "B"] == [(5, 1.5, 1)]
    assert {r["ticker"] for r in got} == {"A", "B"}


def test_shuffles_are_sized_while_a_step_runs(spark):
    before = spark.conf.get(workflow.INITIAL_PARTITIONS, None)
    rows = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("text"))
    with workflow.sized_shuffles(rows) as width:
        assert width == 8 and spark.conf.get(workflow.INITIAL_PARTITIONS) == "8"
    assert spark.conf.get(workflow.INITIAL_PARTITIONS, None) == before
