from __future__ import annotations

import os
import time

from pyspark.sql import functions as F

from claimscale.sources import bundles, files
from claimscale.sources.staging import fresh_path
from claimscale.streaming import ingest


def _texts(df):
    rows = files.with_file_key(df, pattern=bundles.BUNDLE_KEY).select("ticker", F.decode("content", "UTF-8"))
    return sorted(tuple(r) for r in rows.collect())


def _folders(path):
    return sum(len(d) for _, d, _ in os.walk(path.removeprefix("file://")))


def test_documents_come_back_from_their_bundles(spark):
    rows = [(f"k{i}", p, f"page {p} of {i} é 日本\nline") for i in range(200) for p in (2, 0, 1)]
    rows += [("empty", 0, ""), ('odd "key", x', 0, "a"), (None, 0, "no key"), ("none", 0, None)]
    pages = spark.createDataFrame(rows, "ticker string, page int, text string").repartition(5)
    path = fresh_path(spark, "bundles")
    key = bundles.write_bundles(pages, "ticker", "text", path, ["page"], bundle_bytes=4000)
    assert key == bundles.BUNDLE_KEY
    want = sorted(
        [(f"k{i}", "\n".join(f"page {p} of {i} é 日本\nline" for p in range(3))) for i in range(200)]
        + [("empty", ""), ('odd "key", x', "a")]
    )
    scanned = files.read_binary(spark, path, "*.txt")
    assert _texts(bundles.documents_in(scanned)) == want
    assert 1 < _folders(path) <= 6 and 1 < scanned.count() <= 6


def test_folders_do_not_grow_with_keys(spark):
    for n in (10, 400):
        pages = spark.range(n).select(F.col("id").alias("k"), F.lit("x").alias("t"))
        path = fresh_path(spark, "bundles")
        bundles.write_bundles(pages, "k", "t", path)
        assert _folders(path) == 1
        assert bundles.documents_in(files.read_binary(spark, path, "*.txt")).count() == n


def test_bundles_as_a_stream(spark):
    pages = spark.createDataFrame([(f"T{i}", f"<p>Report {i}</p>") for i in range(9)], "k string, t string")
    path, name = fresh_path(spark, "bundles"), f"bundles_{os.getpid()}"
    key = bundles.write_bundles(pages, "k", "t", path, bundle_bytes=60)
    metadata = spark.createDataFrame([("T3", "Org"), ("T5", "Other")], "ticker string, organisation string")
    stream = ingest.file_stream(spark, path, glob="*.txt", files_per_batch=1)
    ingest.drain_to_table(
        ingest.join_metadata(bundles.documents_in(stream), metadata, key), name, fresh_path(spark, "c"), 120
    )
    got = sorted(tuple(r) for r in spark.table(name).select("organisation", "pdf_content").collect())
    assert got == [("Org", "Report 3"), ("Other", "Report 5")]
    spark.sql(f"DROP TABLE {name}")


def test_nothing_to_bundle(spark):
    path = fresh_path(spark, "bundles")
    bundles.write_bundles(spark.createDataFrame([], "k string, t string"), "k", "t", path)


def test_a_bundle_is_not_copied_for_each_of_its_documents(spark):
    pages = spark.range(20000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1500).alias("t"))
    path = fresh_path(spark, "bundles")
    bundles.write_bundles(pages, "k", "t", path)
    begun = time.monotonic()
    found = bundles.documents_in(files.read_binary(spark, path, "*.txt"))
    assert tuple(found.agg(F.count(F.lit(1)), F.sum(F.length("content"))).first()) == (20000, 30000000)
    assert time.monotonic() - begun < 40  # three copies of 30 MB a document took minutes
