"""Many documents in one file: written with an index at its head, cut again at the scan.

A bundle is text.  Its first line says, after its own length in twelve digits, which keys
it holds, where each starts behind that line and how many bytes it has.  A reader needs
nothing else, so bundles can be read in batch or as a stream, and neither files nor
folders are as many as documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimscale.operators.compute import explode_computed

BUNDLE_BYTES = 64 * 1024 * 1024
HEAD_DIGITS = 12
INDEX_SCHEMA = "array<struct<key: string, start: bigint, length: bigint>>"
BUNDLE_KEY = r"#([^#]*)$"


def write_bundles(
    pages: DataFrame,
    key: str,
    content: str,
    path: str,
    order: Sequence[str] = (),
    bundle_bytes: int = BUNDLE_BYTES,
) -> str:
    """Write the documents of ``pages`` into bundles of about ``bundle_bytes``.

    The rows of a key are the pages of its document, in the given order, one after the
    other on lines of their own.  A key belongs to one bundle; a document larger than a
    bundle makes its bundle larger.  Rows without a key or content are left out.
    Returns the pattern that takes the key from the path of a document.
    """
    rows = pages.select(F.col(key).cast("string").alias("key"), F.col(content).alias("value"), *order)
    rows = rows.filter(F.col("key").isNotNull() & F.col("value").isNotNull())
    size = F.octet_length("value") + 1
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    bundles = max(1, -(-total // bundle_bytes))
    bundle = F.pmod(F.xxhash64("key"), F.lit(bundles)).cast("int").alias("bundle")
    # One row per document; a bundle has as many as fit its bytes.
    lengths = rows.groupBy(bundle, "key").agg(F.sum(size).alias("bytes"))
    before = Window.partitionBy("bundle").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    placed = lengths.withColumn("start", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    entry = F.struct("key", "start", (F.col("bytes") - 1).alias("length"))
    index = F.to_json(F.array_sort(F.collect_list(entry))).alias("index")
    heads = placed.groupBy("bundle").agg(index)
    digits = F.lpad(F.octet_length("index").cast("string"), HEAD_DIGITS, "0")
    nothing = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in order]
    head = heads.select("bundle", F.lit("").alias("key"), F.concat(digits, "index").alias("value"), *nothing, F.lit(0).alias("part"))
    body = rows.select(bundle, "key", "value", *order, F.lit(1).alias("part"))
    lines = head.unionByName(body).repartitionById(bundles, F.col("bundle"))
    lines = lines.sortWithinPartitions("bundle", "part", "key", *order)
    lines.select("bundle", "value").write.partitionBy("bundle").text(path)
    return BUNDLE_KEY


def documents_in(bundles: DataFrame) -> DataFrame:
    """path, content: the documents of bundle files (path, content), from a table or stream.

    A document's path is its bundle's, with the key behind ``#``.  Bytes are cut in the
    task that reads them.
    """
    size = F.expr(f"CAST(decode(substring(content, 1, {HEAD_DIGITS}), 'US-ASCII') AS INT)")
    head = F.expr(f"decode(substring(content, {HEAD_DIGITS + 1}, _size), 'UTF-8')")
    opened = bundles.select("path", "content", size.alias("_size"))
    opened = opened.select("path", "content", F.from_json(head, INDEX_SCHEMA).alias("_index"))
    # As a value of an array the bundle is not copied once for each of its documents.
    cut = F.expr(
        "transform(array(content), b -> transform(_index, d -> struct(d.key AS key, substring(b, "
        f"CAST({HEAD_DIGITS} + CAST(decode(substring(b, 1, {HEAD_DIGITS}), 'US-ASCII') AS INT) + 2 + d.start "
        "AS INT), CAST(d.length AS INT)) AS content)))[0]"
    )
    documents = explode_computed(opened, cut, ["path"], "_at", "_document")
    return documents.select(
        F.concat("path", F.lit("#"), F.col("_document.key")).alias("path"),
        F.col("_document.content").alias("content"),
    )
