"""Document files → raw document table, as a stream that drains and stops."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from claimscale import fixed
from claimscale.functions.text import document_text
from claimscale.operators.joins import BROADCAST_BYTES, held_bytes, lookup_join, split_join
from claimscale.sources.files import BINARY_SCHEMA, with_file_key
from claimscale.sources.staging import stage


def file_stream(
    spark: SparkSession,
    path: str,
    schema: str | StructType = BINARY_SCHEMA,
    source: str = "binaryFile",
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files under ``path``, each delivered once."""
    reader = (
        spark.readStream.format(source)
        .schema(schema)
        .option("recursiveFileLookup", "true")
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def organisation_metadata(
    logos: DataFrame, organisations: DataFrame, pattern: str = fixed.FILE_KEY
) -> DataFrame:
    """Logo files ⋈ organisation table on the ticker in the file's path."""
    pictures = with_file_key(logos, pattern=pattern).select(
        "ticker", F.col("content").alias("logo_content")
    )
    wanted = organisations.select("ticker", "organisation", "description")
    return lookup_join(pictures, wanted, ["ticker"])


def join_metadata(
    documents: DataFrame, metadata: DataFrame, pattern: str = fixed.FILE_KEY
) -> DataFrame:
    """Documents (stream or table) ⋈ metadata on the ticker in the file's path.

    Bytes become text before the join, so no document is shuffled as bytes.
    """
    return _in_order(lookup_join(keyed_texts(documents, pattern), metadata, ["ticker"]))


def keyed_texts(documents: DataFrame, pattern: str = fixed.FILE_KEY) -> DataFrame:
    """ticker, pdf_content: of files, or of documents that a bundle names (``path``, ``content``)."""
    return with_file_key(documents, pattern=pattern).select(
        "ticker", document_text(F.col("content")).alias("pdf_content")
    )


def _in_order(joined: DataFrame) -> DataFrame:
    order = ["organisation", "pdf_content", "logo_content", "ticker", "description"]
    return joined.select([c for c in order if c in joined.columns])


def drain_joined(
    stream: DataFrame,
    metadata: DataFrame,
    table: str,
    checkpoint: str,
    pattern: str = fixed.FILE_KEY,
    timeout: int | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> None:
    """Join all new documents with metadata of any size into ``table``, then stop.

    Metadata up to ``max_bytes`` are broadcast by the stream's own join.  Beyond that
    every batch is joined as a table: its heavy keys are found and spread over tasks,
    which a stream can't do.  A batch that runs again, after a failure between its rows
    and its mark in the checkpoint, replaces the partition that bears its number, so no
    row comes twice.
    """
    if held_bytes(metadata) <= max_bytes:
        drain_to_table(join_metadata(stream, metadata, pattern), table, checkpoint, timeout)
        return
    known = stage(metadata, "metadata")

    def write(batch: DataFrame, number: int) -> None:
        write_batch(batch, number, known, table, pattern)

    query = (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .start()
    )
    _awaited(query, table, timeout)


def write_batch(
    batch: DataFrame, number: int, metadata: DataFrame, table: str, pattern: str = fixed.FILE_KEY
) -> None:
    """Join one batch and put it into the partition ``batch = number`` of ``table``."""
    spark = batch.sparkSession
    joined = _in_order(split_join(keyed_texts(batch, pattern), metadata, ["ticker"]))
    columns = ", ".join(f"`{c}` {kind}" for c, kind in joined.dtypes)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, batch BIGINT) USING parquet PARTITIONED BY (batch)"
    )
    view = f"batch_rows_{uuid.uuid4().hex}"
    joined.createOrReplaceTempView(view)
    try:
        # With its value said, only that partition is replaced.
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (batch = {int(number)}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def drain_to_table(
    stream: DataFrame, table: str, checkpoint: str, timeout: int | None = None
) -> None:
    """Append everything that is new to ``table``, then stop.

    The checkpoint remembers what was read: a second run adds only new files.
    Without a ``timeout`` (seconds) it takes as long as it takes.
    """
    query = (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .toTable(table)
    )
    _awaited(query, table, timeout)


def _awaited(query: StreamingQuery, table: str, timeout: int | None) -> None:
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"the stream into {table} took over {timeout} seconds")
