"""Set what organisations say against how they are reported on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscale import fixed
from claimscale.functions.topics import Labels, ordered_labels
from claimscale.operators.aggregates import average_by, explode_positions
from claimscale.operators.joins import lookup_join
from claimscale.operators.matrix import min_max_scale, order_by_row_total, pivot_mean
from claimscale.sources.staging import stage


def walk_the_talk(walk: DataFrame, talk: DataFrame) -> DataFrame:
    """News score minus disclosure score, largest difference first.

    The two sides spell organisations differently, so both are lower-cased.
    """
    reported = walk.select(
        F.lower("organisation").alias("organisation"),
        "topic_id",
        "policy",
        F.col("score").alias("walk"),
    )
    claimed = talk.select(
        F.lower("organisation").alias("organisation"),
        "topic_id",
        F.col("score").alias("talk"),
    )
    return (
        reported.join(claimed, ["organisation", "topic_id"])
        .orderBy((F.col("walk") - F.col("talk")).desc(), "organisation", "topic_id")
        .select("organisation", "topic_id", "policy", "walk", "talk")
    )


def pillar_matrix(scores: DataFrame, pillars: Sequence[str] = fixed.PILLARS) -> DataFrame:
    """Mean score per organisation and pillar, best total first.

    ``scores`` needs organisation, topic and score.
    """
    means = average_by(scores, ["organisation", "topic"], "score")
    matrix = pivot_mean(means, "organisation", "topic", "score", pillars)
    return order_by_row_total(matrix, pillars, "organisation")


def scored_with_topics(scores: DataFrame, topics: DataFrame) -> DataFrame:
    return lookup_join(scores, topics, ["topic_id"])


def policy_matrix(
    weighted: DataFrame, labels: Labels = fixed.TOPIC_LABELS
) -> DataFrame:
    """Mean value per organisation and policy, each policy scaled to [0, 1]."""
    policies = list(dict.fromkeys(x["policy"] for x in ordered_labels(labels)))
    means = pivot_mean(weighted, "organisation", "policy", "esg", policies)
    return min_max_scale(stage(means, "matrix"), policies)


def initiative_matrix(
    chosen: DataFrame, topics: DataFrame, labels: Labels = fixed.TOPIC_LABELS
) -> DataFrame:
    """Policy matrix of the distributions of the chosen initiatives."""
    exploded = explode_positions(chosen, ["organisation"])
    named = lookup_join(exploded, topics, ["topic_id"])
    return policy_matrix(named.withColumnRenamed("probability", "esg"), labels)
