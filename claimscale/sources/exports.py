"""Exports: tables, or single partitions of them, offered to other readers.

An export is a folder.  Each exported table lies in a subfolder as Parquet, and a
manifest table lists share, schema, table, path and partition.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscale.sources.tables import register_files, spread_partitions

MANIFEST_SCHEMA = (
    "share string, schema string, table string, path string, partition string"
)


def _manifest_path(folder: str) -> str:
    return f"{folder}/_claimscale_manifest"


def export_table(
    df: DataFrame,
    folder: str,
    share: str,
    schema: str,
    table: str,
    partition_by: tuple[str, ...] = (),
    partition: dict[str, object] | None = None,
) -> str:
    """Write ``df``, or the rows of one ``partition``, as ``schema.table``.

    The partition filter comes before the write, so that it prunes the source's
    partitions.  Returns the path of the exported files.
    """
    for column, value in (partition or {}).items():
        df = df.filter(F.col(column) == F.lit(value))
    path = f"{folder}/{share}/{schema}/{table}"
    writer = spread_partitions(df, partition_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    described = ", ".join(f"{c} = {v}" for c, v in (partition or {}).items())
    entry = (share, schema, table, path, described)
    # One live entry per table: a new export takes the place of the last one.
    place = "/".join(quote(name, safe="") for name in (share, schema, table))
    (
        df.sparkSession.createDataFrame([entry], MANIFEST_SCHEMA)
        .coalesce(1)
        .write.mode("overwrite")
        .json(f"{_manifest_path(folder)}/{place}")
    )
    return path


def exported_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Every exported table once, as its last export left it."""
    reader = spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true")
    return reader.json(_manifest_path(folder))


def read_export(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def register_export(spark: SparkSession, path: str, table: str) -> None:
    """Make an exported table readable by name in SQL."""
    register_files(spark, table, path)
