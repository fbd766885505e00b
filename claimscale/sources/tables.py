"""Table life cycle in the session catalog."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from claimscale.sources.staging import fresh_path

CATALOG = "spark_catalog"


def quoted(name: str) -> str:
    """Quote each part of a dotted name."""
    return ".".join(f"`{part}`" for part in name.split("."))


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_schema(
    spark: SparkSession, schema: str, location: str | None = None, comment: str = ""
) -> None:
    sql = f"CREATE SCHEMA IF NOT EXISTS {quoted(schema)}"
    if comment:
        sql += f" COMMENT {text_literal(comment)}"
    if location:
        sql += f" LOCATION {text_literal(location)}"
    spark.sql(sql)


def fresh_schema(spark: SparkSession) -> str:
    """A new schema whose managed tables lie in the shared folder."""
    name = f"claimscale_{uuid.uuid4().hex}"
    create_schema(spark, name, fresh_path(spark, "schema"))
    return name


def use_schema(spark: SparkSession, schema: str) -> None:
    spark.catalog.setCurrentDatabase(schema)


def show_schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS")


def describe_schema(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"DESCRIBE SCHEMA EXTENDED {quoted(schema)}")


def show_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {quoted(schema)}")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}")


def table_names(schema: str, table: str) -> list[str]:
    """The three names under which one table can be read.

    The last needs ``use_schema`` first.
    """
    return [f"{CATALOG}.{schema}.{table}", f"{schema}.{table}", table]


def create_table(
    spark: SparkSession,
    table: str,
    columns: str,
    partition_by: Sequence[str] = (),
    location: str | None = None,
) -> None:
    """Create a managed table, or an external one when a location is given."""
    sql = f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({columns}) USING parquet"
    if partition_by:
        sql += f" PARTITIONED BY ({', '.join(quoted(c) for c in partition_by)})"
    if location:
        sql += f" LOCATION {text_literal(location)}"
    spark.sql(sql)


def register_files(spark: SparkSession, table: str, path: str) -> None:
    """External table over existing files; their schema is taken as it is."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(table)} USING parquet "
        f"LOCATION {text_literal(path)}"
    )


def location_of(spark: SparkSession, table: str) -> str:
    """Where a table's files lie, as its description says."""
    described = describe_table(spark, table)
    return described.filter("col_name = 'Location'").first()["data_type"]


def columns_of(spark: SparkSession, table: str) -> str:
    """A table's columns as they are written in a CREATE TABLE."""
    columns = spark.catalog.listColumns(table)
    return ", ".join(f"{quoted(c.name)} {c.dataType}" for c in columns)


def move_external(spark: SparkSession, source: str, target: str) -> None:
    """Declare an external table anew under another name and drop the old name.

    The files stay where they are.
    """
    create_table(
        spark,
        target,
        columns_of(spark, source),
        partition_columns(spark, source),
        location_of(spark, source),
    )
    if partition_columns(spark, source):
        spark.catalog.recoverPartitions(target)
    drop_table(spark, source, must_exist=True)


def insert_values(
    spark: SparkSession, table: str, columns: Sequence[str], rows_sql: str
) -> None:
    """INSERT … VALUES with named columns.

    Partition columns are stored last, so positions alone would not do.
    """
    names = ", ".join(quoted(c) for c in columns)
    spark.sql(f"INSERT INTO {quoted(table)} ({names}) VALUES {rows_sql}")


def spread_partitions(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather each partition's rows into few files.

    A rebalance also splits a partition that holds most of the table, where a
    repartition by the same columns would put it into a single task.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def replace_table(
    df: DataFrame, table: str, partition_by: Sequence[str] = ()
) -> None:
    writer = spread_partitions(df, partition_by).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.mode("overwrite").saveAsTable(table)


def append_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows; a partitioned table needs its partition columns named again."""
    writer = spread_partitions(df, partition_by).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.mode("append").saveAsTable(table)


def create_table_as(spark: SparkSession, table: str, select_sql: str) -> None:
    spark.sql(f"CREATE TABLE {quoted(table)} USING parquet AS {select_sql}")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    """Full, independent copy with the same partition columns."""
    replace_table(spark.table(source), target, partition_columns(spark, source))


def drop_table(spark: SparkSession, table: str, must_exist: bool = False) -> None:
    """Drop a table.  A managed one loses its files, an external one keeps them."""
    exists = "" if must_exist else "IF EXISTS "
    spark.sql(f"DROP TABLE {exists}{quoted(table)}")
