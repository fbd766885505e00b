"""Columns that are dear to compute, computed once per row.

The optimizer moves a filter on a computed column below the projection that
computes it, and so computes it twice; for an inner explode it even invents such
filters.  It moves nothing below an outer explode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, name: str, column: Column) -> DataFrame:
    """``withColumn`` for a column that will be filtered on."""
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode_outer(F.array(column)).alias(name))


def explode_computed(
    df: DataFrame, array: Column, keep: Sequence[str], position: str, value: str
) -> DataFrame:
    """Explode an array that is not a plain column."""
    exploded = df.select(*keep, F.posexplode_outer(array).alias(position, value))
    return exploded.filter(F.col(position).isNotNull())
