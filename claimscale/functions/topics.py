"""Topic distributions: arrays of probabilities, position = topic id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from claimscale import fixed

Labels = Sequence[Mapping[str, object]]


def ordered_labels(labels: Labels) -> list[Mapping[str, object]]:
    """Labels by topic id; ids must be 0 … k-1, as they stand for positions."""
    ordered = sorted(labels, key=lambda label: label["topic_id"])
    if [label["topic_id"] for label in ordered] != list(range(len(ordered))):
        raise ValueError("topic ids must be 0 to k-1, each once")
    return ordered


def top_probability(distribution: Column) -> Column:
    return F.array_max(distribution)


def top_topic(distribution: Column) -> Column:
    """0-based position of the largest probability, the first one on a tie."""
    best = F.array_position(distribution, F.array_max(distribution))
    return (best - 1).cast("int")


def name_positions(distribution: Column, labels: Labels = fixed.TOPIC_LABELS) -> Column:
    """Each probability of a distribution with the label of its position.

    Gives array<struct<probability, topic_id, topic, policy>>.  Positions past the
    labels have null labels, labels past the distribution a null probability.
    """
    missing = F.greatest(F.lit(len(labels)) - F.size(distribution), F.lit(0))
    whole = F.concat(distribution, F.array_repeat(F.lit(None).cast("double"), missing))
    known = F.array(
        *(
            F.struct(
                F.lit(label["topic_id"]).alias("id"),
                F.lit(label["topic"]).alias("topic"),
                F.lit(label["policy"]).alias("policy"),
            )
            for label in ordered_labels(labels)
        )
    )

    def named(probability: Column, position: Column) -> Column:
        label = F.get(known, position)
        return F.struct(
            probability.alias("probability"),
            label["id"].alias("topic_id"),
            label["topic"].alias("topic"),
            label["policy"].alias("policy"),
        )

    return F.transform(whole, named)


def any_starts_with(values: Column, prefix: str = fixed.THEME_PREFIX) -> Column:
    """True when an element starts with the prefix; null arrays give false."""
    return F.coalesce(F.exists(values, lambda v: v.startswith(prefix)), F.lit(False))


def register_sql_functions(spark: SparkSession) -> None:
    """Make the distribution functions callable from SQL text."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION top_topic(p ARRAY<DOUBLE>) "
        "RETURNS INT RETURN CAST(array_position(p, array_max(p)) - 1 AS INT)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION top_probability(p ARRAY<DOUBLE>) "
        "RETURNS DOUBLE RETURN array_max(p)"
    )
