"""Report matrices: one row per organisation, one column per policy or pillar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_mean(
    df: DataFrame, row: str, column: str, value: str, columns: Sequence[str]
) -> DataFrame:
    """Mean of ``value`` per cell; ``columns`` are given, so no job looks for them."""
    return df.groupBy(row).pivot(column, list(columns)).agg(F.avg(value))


def min_max_scale(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale each column to [0, 1] over all rows.

    The bounds are one aggregated row, read as a scalar subquery.  A column with
    a single value becomes 0; an empty cell stays empty.
    """
    bounds = matrix.select(
        F.struct(
            *[F.min(c).alias(f"low_{c}") for c in columns],
            *[F.max(c).alias(f"high_{c}") for c in columns],
        ).alias("bounds")
    ).scalar()
    scaled = {}
    for c in columns:
        low, high = bounds[f"low_{c}"], bounds[f"high_{c}"]
        share = F.try_divide(F.col(c) - low, high - low)
        scaled[c] = F.when(F.col(c).isNotNull(), F.coalesce(share, F.lit(0.0)))
    return matrix.withColumns(scaled)


def order_by_row_total(
    matrix: DataFrame, columns: Sequence[str], tiebreak: str
) -> DataFrame:
    """Largest row total first; an empty cell counts 0."""
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in columns), F.lit(0.0))
    return matrix.orderBy(total.desc(), F.asc(tiebreak))
