"""Aggregations.  All combine on the map side, so a hot key costs no more."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscale import fixed
from claimscale.functions.topics import Labels, name_positions, ordered_labels
from claimscale.operators.compute import with_computed


def explode_topics(df: DataFrame, column: str = "probabilities") -> DataFrame:
    """One row per labelled topic, its fields next to all other columns."""
    return df.withColumn(column, F.explode(column)).select("*", f"{column}.*")


def explode_positions(
    df: DataFrame, keep: Sequence[str], column: str = "probabilities"
) -> DataFrame:
    """One row per position of a plain distribution, without labels."""
    return df.select(*keep, F.posexplode(column).alias("topic_id", "probability"))


def label_distribution(
    df: DataFrame,
    column: str = "probabilities",
    labels: Labels = fixed.TOPIC_LABELS,
) -> DataFrame:
    return df.withColumn(column, name_positions(F.col(column), labels))


def _per_topic(
    df: DataFrame,
    by: Sequence[str],
    measures: dict[str, list[Column]],
    labels: Labels,
) -> DataFrame:
    """Aggregate positions side by side, then turn them into one row per topic.

    Exploding first would multiply the input rows by the number of topics; this
    multiplies only the groups.
    """
    ordered = ordered_labels(labels)
    sums = [
        F.sum(column).alias(f"{name}_{i}")
        for name, columns in measures.items()
        for i, column in enumerate(columns)
    ]
    rows = [
        F.struct(
            *[F.lit(label[f]).alias(f) for f in ("topic_id", "topic", "policy")],
            *[F.col(f"{name}_{i}").alias(name) for name in measures],
        )
        for i, label in enumerate(ordered)
    ]
    return df.groupBy(*by).agg(*sums).select(*by, F.inline(F.array(*rows)))


def _with_positions(
    df: DataFrame, distribution: Column, keep: Sequence[str], labels: Labels
) -> tuple[DataFrame, list[Column]]:
    """``keep`` and the distribution, worked out and tested once; the probability at each label.

    A distribution longer than the labels is an error, not a loss.
    """
    k = len(labels)
    message = F.lit(f"a distribution has more positions than the {k} labels")
    fits = F.when(F.size("_p") > k, F.raise_error(message).cast("boolean")).otherwise(F.size("_p") > 0)
    rows = with_computed(df.select(*keep, distribution.alias("_given")), "_p", F.col("_given"))
    return rows.filter(fits), [F.get("_p", F.lit(i)) for i in range(k)]


def topic_mass(
    df: DataFrame,
    by: Sequence[str] = ("organisation",),
    distribution: str = "probabilities",
    mass: str = "esg",
    labels: Labels = fixed.TOPIC_LABELS,
) -> DataFrame:
    """Sum of probability per (group, topic) of a plain distribution."""
    rows, columns = _with_positions(df, F.col(distribution), by, labels)
    return _per_topic(rows, by, {mass: columns}, labels)


def weighted_tone(
    df: DataFrame,
    by: Sequence[str] = ("organisation",),
    distribution: str = "probabilities.probability",
    tone: str = "tone",
    labels: Labels = fixed.TOPIC_LABELS,
) -> DataFrame:
    """Mean tone per (group, topic), weighted by the topic's probability."""
    rows, weights = _with_positions(df, F.col(distribution), [*by, tone], labels)
    measures = {
        "weightedTone": [w * F.col(tone) for w in weights],
        "weights": weights,
    }
    return _per_topic(rows, by, measures, labels).withColumn(
        "esg", F.try_divide("weightedTone", "weights")
    )


def average_by(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(value).alias(value))


def rows_per_key(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).count()


def sum_per_key(df: DataFrame, key: str, value: str, total: str) -> DataFrame:
    """Sum per key, largest first."""
    sums = df.groupBy(key).agg(F.sum(value).alias(total))
    return sums.orderBy(F.desc(total), F.asc(key))


def articles_per_day(
    df: DataFrame, day: str = "date", by: Sequence[str] = ("organisation",)
) -> DataFrame:
    """Rows per calendar day and group.

    The day is grouped, not the time stamp it comes from.
    """
    return (
        df.groupBy(F.to_date(day).alias("date"), *by)
        .agg(F.count(F.lit(1)).alias("article_count"))
        .select("article_count", "date", *by)
    )


def distinct_count(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.countDistinct(column).alias(name))
