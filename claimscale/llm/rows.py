"""Row identities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscale.sources.staging import stage


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def with_row_ids(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a number for each row, written once so that the numbers last."""
    name = free_name(df, "row_id")
    return stage(df.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def row_key(df: DataFrame, key: str = "doc_id") -> tuple[DataFrame, str]:
    """``df`` and a column that tells its rows apart.

    That is ``key`` where it has no nulls and no repeats, else a number given to
    each row.
    """
    rows, keys = df.agg(F.count(F.lit(1)), F.count_distinct(key)).first()
    return (df, key) if rows == keys else with_row_ids(df)


def ordered_key(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """doc, text: whole numbers that tell rows apart and follow the order of ``key``.

    ``doc`` is the key itself where it has no nulls and no repeats.  Else rows are
    numbered in its order, nulls first, repeats by text, and the key stays as doc_id.
    """
    read = df.select(F.col(key).cast("long").alias("doc_id"), "text")
    rows, keys = read.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if rows == keys:
        return read.withColumnRenamed("doc_id", "doc")
    ranged = read.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stage(ranged.withColumn("doc", F.monotonically_increasing_id()), "ordered")
