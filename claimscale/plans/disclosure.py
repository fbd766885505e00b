"""What organisations say: documents → statements → initiatives → scores."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscale import fixed
from claimscale.functions.text import explode_statements, split_sentences
from claimscale.functions.topics import Labels
from claimscale.operators.aggregates import topic_mass
from claimscale.operators.joins import lookup_join
from claimscale.operators.ranking import rank_score, top_per_key
from claimscale.operators.topic_model import Model, score_topics


def clean_statements(
    documents: DataFrame,
    text: str = "pdf_content",
    keep: Sequence[str] = ("ticker", "organisation"),
    min_chars: int = fixed.MIN_STATEMENT_CHARS,
    split: Callable[[Column], Column] = split_sentences,
    mark: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    return explode_statements(documents, text, keep, min_chars, split, mark)


def topic_statements(model: Model, statements: DataFrame) -> DataFrame:
    return score_topics(model, statements, "statement")


def initiatives(
    statements: DataFrame,
    topics: DataFrame,
    tiebreak: Sequence[str],
    min_probability: float = fixed.MIN_PROBABILITY,
) -> DataFrame:
    """The most descriptive statement per (organisation, topic).

    A pair whose best statement is not above ``min_probability`` has none.  As
    the threshold is on the column that is ranked, it can be applied first, and
    the rows below it are never sorted or shuffled.
    """
    best = top_per_key(
        statements.filter(F.col("probability") > min_probability),
        ["organisation", "topic_id"],
        [F.desc("probability"), *[F.asc(c) for c in tiebreak]],
        1,
    )
    return lookup_join(best, topics, ["topic_id"]).drop("rank")


def csr_scores(
    chosen: DataFrame,
    entity: str = "ticker",
    labels: Labels = fixed.TOPIC_LABELS,
    rounded: bool = True,
) -> DataFrame:
    """Rank organisations within each topic by their probability mass."""
    mass = topic_mass(chosen, ["organisation"], labels=labels)
    scored = rank_score(
        mass,
        "topic_id",
        "esg",
        "organisation",
        population=chosen,
        entity=entity,
        rounded=rounded,
    )
    return scored.select("organisation", "topic_id", "score")
