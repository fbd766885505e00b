from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimscale.sources import files, tables
from claimscale.sources.staging import fresh_path
from claimscale.streaming import ingest


@pytest.fixture
def documents(spark):
    rows = [(f"T{i}", f"<p>Report {i} &amp; more</p>") for i in range(6)]
    return spark.createDataFrame(rows, "ticker string, body string")


@pytest.fixture
def metadata(spark):
    rows = [(f"T{i}", f"Org {i}", f"about {i}") for i in range(5)]
    return spark.createDataFrame(rows, "ticker string, organisation string, description string")


def test_second_run_adds_only_new_files(spark, documents, metadata):
    path, checkpoint = fresh_path(spark, "docs"), fresh_path(spark, "checkpoint")
    name = f"{tables.fresh_schema(spark)}.raw_documents"
    key = files.write_document_files(documents, "ticker", "body", path)

    def run():
        stream = ingest.file_stream(spark, path, glob="*.txt", files_per_batch=2)
        joined = ingest.join_metadata(stream, metadata, key)
        ingest.drain_to_table(joined, name, checkpoint, timeout=120)
        return sorted(
            tuple(r) for r in spark.table(name).select("ticker", "pdf_content").collect()
        )

    first = run()
    assert first == [(f"T{i}", f"Report {i} & more") for i in range(5)]
    assert run() == first
    extra = spark.createDataFrame([("T4b", "x"), ("T3", "<b>new</b>")], documents.schema)
    extra.write.mode("append").partitionBy("ticker").text(path)
    assert run() == sorted([*first, ("T3", "new")])


def test_large_metadata_is_not_broadcast_in_a_stream(spark, documents, metadata):
    path = fresh_path(spark, "docs")
    files.write_document_files(documents, "ticker", "body", path)
    stream = ingest.file_stream(spark, path).withColumn("ticker", F.lit("T1"))
    joined = ingest.lookup_join(stream, metadata, ["ticker"], max_bytes=1)
    assert joined.isStreaming
    assert "broadcast" not in joined._jdf.queryExecution().analyzed().toString()


def test_logos_join_organisations(spark, metadata):
    path = fresh_path(spark, "logos")
    rows = spark.createDataFrame([("T1", "logo"), ("ZZ", "none")], "ticker string, b string")
    key = files.write_document_files(rows, "ticker", "b", path)
    joined = ingest.organisation_metadata(files.read_binary(spark, path, "*.txt"), metadata, key)
    got = joined.select("ticker", "organisation", F.decode("logo_content", "UTF-8")).collect()
    assert [tuple(r) for r in got] == [("T1", "Org 1", "logo\n")]


def test_a_stream_meets_metadata_of_any_size_batch_by_batch(spark, documents, metadata):
    path, checkpoint = fresh_path(spark, "docs"), fresh_path(spark, "checkpoint")
    name = f"{tables.fresh_schema(spark)}.raw_documents"
    key = files.write_document_files(documents, "ticker", "body", path)

    def run():
        stream = ingest.file_stream(spark, path, glob="*.txt", files_per_batch=2)
        ingest.drain_joined(stream, metadata, name, checkpoint, key, timeout=120, max_bytes=1)
        return sorted(tuple(r) for r in spark.table(name).select("ticker", "pdf_content").collect())

    first = run()
    assert first == [(f"T{i}", f"Report {i} & more") for i in range(5)]
    assert run() == first
    extra = spark.createDataFrame([("T4b", "x"), ("T3", "<b>new</b>")], documents.schema)
    extra.write.mode("append").partitionBy("ticker").text(path)
    assert run() == sorted([*first, ("T3", "new")])
    assert spark.table(name).select("batch").distinct().count() > 2


def test_a_batch_that_runs_again_adds_nothing(spark, documents, metadata):
    path = fresh_path(spark, "docs")
    name = f"{tables.fresh_schema(spark)}.raw_documents"
    key = files.write_document_files(documents, "ticker", "body", path)
    batch = files.read_binary(spark, path, "*.txt")
    for number in (0, 1, 0, 1, 1):
        ingest.write_batch(batch, number, metadata, name, key)
    counts = spark.table(name).groupBy("batch").count().collect()
    assert sorted(map(tuple, counts)) == [(0, 5), (1, 5)]
    ingest.write_batch(batch.limit(0), 2, metadata, name, key)
    assert spark.table(name).count() == 10


def test_a_hot_document_key_spreads_in_a_batch(spark):
    body = F.encode(F.lit("<p>text</p>"), "UTF-8")
    paths = F.concat(F.lit("/docs/"), F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.col("id").cast("string")), F.lit(".txt"))
    batch = spark.range(0, 6000, 1, 6).select(paths.alias("path"), body.alias("content"))
    metadata = spark.createDataFrame([("hot", "Org")], "ticker string, organisation string")
    name = f"{tables.fresh_schema(spark)}.hot"
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ingest.write_batch(batch, 0, metadata, name)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    written = spark.table(name)
    sizes = [r["count"] for r in written.groupBy(F.input_file_name().alias("f")).count().collect()]
    assert written.count() == 4000 and len(sizes) > 32 and max(sizes) < 500
