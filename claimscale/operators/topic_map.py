"""What topics are about, how large they are and how far they lie from each other.

All of it works on a table of terms (term, count, weights: one number per topic), such as
``BayesTopics.matrix``, by sums over its rows; only figures per topic, or per pair of
topics, leave the executors.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscale.operators.ranking import top_per_key

RELEVANCE = 0.6


def _totals(terms: DataFrame, topics: int) -> list[Column]:
    """The sums of the weights by topic, as scalar subqueries of one row."""
    sums = [F.sum(F.get("weights", F.lit(i))).alias(f"t{i}") for i in range(topics)]
    row = terms.agg(*sums).first()
    return [F.lit(t) for t in row]


def relevant_terms(
    terms: DataFrame, topics: int, n: int = 10, weight: float = RELEVANCE
) -> DataFrame:
    """topic_id, rank, term, share, lift, relevance: the ``n`` most telling terms per topic.

    ``share`` is the term's part of the topic, ``lift`` that share over the term's part of
    the corpus.  Relevance is the logarithm of the share, with ``weight``, and of the lift
    with what is left of 1: at 1 the usual words lead, at 0 those that are the topic's own.
    """
    totals = F.array(*_totals(terms, topics))
    all_words = terms.select(F.sum("count")).scalar()
    rows = terms.select(
        "term",
        (F.col("count") / all_words).alias("usual"),
        F.posexplode("weights").alias("topic_id", "w"),
    )
    share = F.col("w") / F.get(totals, F.col("topic_id"))
    rows = rows.select("topic_id", "term", share.alias("share"), (share / F.col("usual")).alias("lift"))
    relevance = weight * F.log("share") + (1 - weight) * F.log("lift")
    # Nine digits: terms with the same counts are in the order of the alphabet.
    scored = rows.withColumn("relevance", F.round(relevance, 9))
    best = top_per_key(scored, ["topic_id"], [F.desc("relevance"), F.asc("term")], n)
    return best.select("topic_id", "rank", "term", "share", "lift", "relevance")


def topic_distances(terms: DataFrame, topics: int) -> DataFrame:
    """topic_a, topic_b, distance: the square root of the Jensen-Shannon divergence, in bits."""
    totals = _totals(terms, topics)
    p = [F.get("weights", F.lit(i)) / totals[i] for i in range(topics)]

    def half(a: Column, b: Column) -> Column:
        part = a * F.log2(a / ((a + b) / 2))
        return F.when(a > 0, part).otherwise(0.0)

    sums = [
        F.sum((half(p[a], p[b]) + half(p[b], p[a])) / 2).alias(f"d{a}_{b}")
        for a, b in combinations(range(topics), 2)
    ]
    if not sums:
        return terms.sparkSession.createDataFrame([], "topic_a int, topic_b int, distance double")
    rows = [
        F.struct(
            F.lit(a).alias("topic_a"),
            F.lit(b).alias("topic_b"),
            F.sqrt(F.greatest(F.col(f"d{a}_{b}"), F.lit(0.0))).alias("distance"),
        )
        for a, b in combinations(range(topics), 2)
    ]
    return terms.agg(*sums).select(F.inline(F.array(*rows)))


def topic_map(terms: DataFrame, topics: int) -> DataFrame:
    """topic_id, share, x, y: the topics' shares of all weight, and a place for each.

    The places keep the distances between topics as well as two numbers can: classical
    scaling of the matrix of distances, which has one row per topic.  The first topic
    that is off an axis has a positive place on it.
    """
    far = np.zeros((topics, topics))
    for row in topic_distances(terms, topics).collect():
        far[row["topic_a"], row["topic_b"]] = far[row["topic_b"], row["topic_a"]] = row["distance"]
    places = scaled_places(far)
    totals = [t for t in terms.agg(*[F.sum(F.get("weights", F.lit(i))) for i in range(topics)]).first()]
    rows = [
        (i, float(t / sum(totals)), float(x), float(y)) for i, (t, (x, y)) in enumerate(zip(totals, places))
    ]
    return terms.sparkSession.createDataFrame(rows, "topic_id int, share double, x double, y double")


def scaled_places(far: np.ndarray) -> np.ndarray:
    """Two coordinates for each row of a matrix of distances."""
    n = len(far)
    centre = np.eye(n) - 1 / n
    values, vectors = np.linalg.eigh(-centre @ (far**2) @ centre / 2)
    best = np.argsort(values)[::-1][:2]
    places = vectors[:, best] * np.sqrt(np.maximum(values[best], 0))
    places = np.pad(places, ((0, 0), (0, 2 - places.shape[1])))
    for axis in range(2):
        off = np.flatnonzero(np.abs(places[:, axis]) > 1e-9)
        if len(off) and places[off[0], axis] < 0:
            places[:, axis] *= -1
    return places
