"""Top rows per key and row numbers over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimscale.operators.joins import BROADCAST_BYTES, held_bytes
from claimscale.session import shuffle_width
from claimscale.sources.staging import stage

ONE_TASK_ROWS = 1_000_000
GROUP_LIMIT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"


def group_limit(spark: SparkSession) -> int:
    """The most rows per key that Spark cuts to before a shuffle."""
    return int(spark.conf.get(GROUP_LIMIT_SETTING, "1000"))


def top_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
) -> DataFrame:
    """The first ``n`` rows of each key, numbered from 1.

    ``order`` must end in a tiebreak.  Spark cuts every map task's share of a key
    to ``n`` rows before the shuffle (WindowGroupLimit), so a key that holds most
    of the table still sends only ``n`` rows per map task.  It does so up to a
    configured ``n``; above it the ranking is done by ranges instead.
    """
    if n > group_limit(df.sparkSession):
        ranked = rank_within(df, keys, order, rank)  # ranks are long there
    else:
        window = Window.partitionBy(*keys).orderBy(*order)
        ranked = df.withColumn(rank, F.row_number().over(window))
    return ranked.filter(F.col(rank) <= n).withColumn(rank, F.col(rank).cast("int"))


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    rank: str = "rank",
    one_task_rows: int = ONE_TASK_ROWS,
    staged: bool = False,
) -> DataFrame:
    """Number all rows of each key from 1 in the given total order.

    A window gives a key to one task.  With a handful of keys, such as topics,
    that is only fine while the table is known to be small; larger ones are
    ranked by ranges.  Both ways give the same numbers.  ``staged`` says that
    ``df`` is a written table already.
    """
    frozen = df if staged else stage(df, "to-rank")
    if frozen.count() <= one_task_rows:
        window = Window.partitionBy(*keys).orderBy(*order)
        return frozen.withColumn(rank, F.row_number().over(window).cast("long"))
    return rank_by_ranges(frozen, keys, order, rank)


def rank_by_ranges(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    rank: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """Row numbers per key from one distributed sort.

    The rows are range-partitioned by (keys, order) and sorted, which makes
    position = partition block + offset.  The sorted table is staged, so the
    positions are final; one small count per (key, block) then tells how many
    rows of a key lie in earlier blocks.
    """
    keys = list(keys)
    by = [F.col(k) for k in keys] + list(order)
    if partitions is None:
        partitions = shuffle_width(df.sparkSession)
    block = F.shiftright(F.col("_at"), 33)
    placed = stage(
        df.repartitionByRange(partitions, *by)
        .sortWithinPartitions(*by)
        .withColumn("_at", F.monotonically_increasing_id()),
        "ranked",
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_in")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # At most one row per key and block.
    shifts = (
        placed.groupBy(*keys, block.alias("_in"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .select(
            *[F.col(k).alias(f"_of_{k}") for k in keys],
            "_in",
            (F.col("_before") - F.col("_first") + 1).alias("_shift"),
        )
    )
    if held_bytes(shifts) <= BROADCAST_BYTES:
        shifts = F.broadcast(shifts)
    # A null key is a key like any other here.
    same = [block == F.col("_in")]
    same += [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return placed.join(shifts, same).select(
        *df.columns, (F.col("_at") + F.col("_shift")).alias(rank)
    )


def rank_score(
    df: DataFrame,
    key: str,
    value: str,
    tiebreak: str,
    population: DataFrame,
    entity: str,
    score: str = "score",
    rounded: bool = False,
    staged: bool = False,
) -> DataFrame:
    """Score = row number within ``key`` by ascending ``value``, in percent.

    The divisor is the number of distinct ``entity`` values in ``population``, a
    scalar subquery: no extra driver round trip and no cross join.
    """
    entities = population.select(F.countDistinct(entity).alias("n")).scalar()
    order = [F.asc(value), F.asc(tiebreak)]
    ranked = rank_within(df, [key], order, staged=staged)
    percent = F.col("rank") * 100 / entities
    return ranked.withColumn(score, F.round(percent) if rounded else percent)
