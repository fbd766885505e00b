"""The pipelines from files to tables, each step written under its own name.

A table between two steps is what later steps, dashboards and repeated runs read;
it also cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from claimscale import fixed
from claimscale.functions import sentences
from claimscale.functions.text import explode_clean_paragraphs, split_sentences
from claimscale.functions.topics import Labels
from claimscale.operators import bayes_topics, topic_model
from claimscale.operators.joins import held_bytes
from claimscale.plans import compare, disclosure, news
from claimscale.session import INITIAL_PARTITIONS, size_shuffles
from claimscale.sources.files import clustered, spread, topic_dimension
from claimscale.sources.staging import stage
from claimscale.sources.tables import replace_table
from claimscale.streaming.ingest import drain_joined, file_stream

RAW = "raw_documents"
STATEMENTS = "clean_sentences"
SCORED = "topic_sentences"
INITIATIVES = "esg_initiatives"
TALK = "csr_scores"
NEWS = "prepared_news"
NEWS_TOPICS = "news_topics"
WALK = "news_scores"

STATEMENT_ID = ("ticker", "paragraph_no", "sentence_no")


@contextmanager
def sized_shuffles(*inputs: DataFrame) -> Iterator[int]:
    """Shuffles wide enough for what the inputs hold, while the block runs.

    Their sizes are measured by one aggregate each; afterwards the session has its own
    width again.
    """
    spark = inputs[0].sparkSession
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    width = size_shuffles(spark, sum(held_bytes(df) for df in inputs))
    try:
        yield width
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)


def ingest_documents(
    spark: SparkSession,
    path: str,
    metadata: DataFrame,
    schema: str,
    checkpoint: str,
    pattern: str = fixed.FILE_KEY,
    glob: str | None = None,
    files_per_batch: int | None = None,
    timeout: int | None = None,
) -> DataFrame:
    """Append new document files, with their metadata, to the raw table."""
    table = f"{schema}.{RAW}"
    # Every micro-batch reads the metadata, so it is computed only once.
    known = stage(metadata, "metadata")
    stream = file_stream(spark, path, glob=glob, files_per_batch=files_per_batch)
    drain_joined(stream, known, table, checkpoint, pattern, timeout)
    return spark.table(table).drop("batch")


def build_statements(
    spark: SparkSession,
    schema: str,
    min_chars: int = fixed.MIN_STATEMENT_CHARS,
    learned: bool = False,
) -> DataFrame:
    """Clean statements of the raw documents.

    Sentences end by the fixed rule, or, if ``learned``, by what the documents themselves
    say about abbreviations and sentence openings.
    """
    table = spark.table(f"{schema}.{RAW}")
    with sized_shuffles(table.select("pdf_content")):
        raw, rule = spread(table), sentences.Rule(split_sentences)
        if learned:
            rule = sentences.rule(stage(explode_clean_paragraphs(raw, "pdf_content", []), "paragraphs"))
        cleaned = disclosure.clean_statements(raw, min_chars=min_chars, split=rule.split, mark=rule.mark)
        replace_table(cleaned, f"{schema}.{STATEMENTS}")
    return spark.table(f"{schema}.{STATEMENTS}")


def train(
    spark: SparkSession,
    schema: str,
    model_path: str,
    labels: Labels = fixed.TOPIC_LABELS,
    **options,
) -> topic_model.Model:
    """Fit as many topics as there are labels; save the model with its labels.

    Every statement counts in every pass, and no matrix is held by the driver.
    """
    statements = spark.table(f"{schema}.{STATEMENTS}")
    with sized_shuffles(statements):
        model = bayes_topics.fit(
            statements, order=STATEMENT_ID, topics=len(labels), path=model_path, **options
        )
    topic_model.save_model(model, model_path, labels)
    return model


def _model_with_labels(path: str) -> tuple[topic_model.Model, Labels]:
    """A saved model and its own labels; they cannot part."""
    model, labels = topic_model.load_model(path), topic_model.load_labels(path)
    topic_model.check_labels(model, labels)
    return model, labels


def prepare_news_table(
    spark: SparkSession,
    raw: DataFrame,
    organisations: DataFrame,
    schema: str,
    keep: tuple[str, ...] = ("organisation",),
    **options,
) -> DataFrame:
    """Write the prepared news: the latest titled articles on a theme, per ticker."""
    replace_table(news.prepare_news(raw, organisations, keep, **options), f"{schema}.{NEWS}")
    return spark.table(f"{schema}.{NEWS}")


def build_disclosure_scores(
    spark: SparkSession,
    schema: str,
    model_path: str,
    min_probability: float = fixed.MIN_PROBABILITY,
) -> DataFrame:
    """Score statements, choose initiatives and rank the organisations."""
    model, labels = _model_with_labels(model_path)
    statements = spark.table(f"{schema}.{STATEMENTS}")
    with sized_shuffles(statements):
        scored = disclosure.topic_statements(model, spread(statements))
        replace_table(scored, f"{schema}.{SCORED}")
    chosen = disclosure.initiatives(
        spark.table(f"{schema}.{SCORED}"),
        topic_dimension(spark, labels),
        STATEMENT_ID[1:],
        min_probability,
    )
    # Readers look initiatives up by ticker.
    replace_table(clustered(chosen, "ticker", ["topic_id"]), f"{schema}.{INITIATIVES}")
    scores = disclosure.csr_scores(spark.table(f"{schema}.{INITIATIVES}"), labels=labels)
    replace_table(scores, f"{schema}.{TALK}")
    return spark.table(f"{schema}.{TALK}")


def build_news_scores(
    spark: SparkSession,
    articles: DataFrame,
    schema: str,
    model_path: str,
) -> DataFrame:
    """Classify articles with the model of the disclosures and rank by tone."""
    model, labels = _model_with_labels(model_path)
    with sized_shuffles(articles):
        classified = news.classify_news(model, articles, labels)
        replace_table(classified, f"{schema}.{NEWS_TOPICS}")
    scores = news.news_scores(spark.table(f"{schema}.{NEWS_TOPICS}"), labels)
    replace_table(scores, f"{schema}.{WALK}")
    return spark.table(f"{schema}.{WALK}")


def comparison(spark: SparkSession, schema: str) -> DataFrame:
    return compare.walk_the_talk(
        spark.table(f"{schema}.{WALK}"), spark.table(f"{schema}.{TALK}")
    )
