"""What the news says: prepared articles → topics → weighted tone → scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimscale import fixed
from claimscale.functions.text import title
from claimscale.functions.topics import Labels, any_starts_with
from claimscale.operators.aggregates import label_distribution, weighted_tone
from claimscale.operators.compute import with_computed
from claimscale.operators.joins import lookup_join
from claimscale.operators.ranking import group_limit, rank_score, top_per_key
from claimscale.operators.topic_model import Model, distributions
from claimscale.sources.staging import stage

NEWS_COLUMNS = ("date", "organisation", "url", "tone", "title")


def prepare_news(
    raw: DataFrame,
    organisations: DataFrame,
    keep: Sequence[str] = (),
    latest: int = fixed.LATEST_PER_TICKER,
    prefix: str = fixed.THEME_PREFIX,
    title_tag: str = fixed.TITLE_TAG,
    many_copies: bool = True,
) -> DataFrame:
    """The latest titled articles on a theme, per ticker.

    Theme and title filters need only the article, so they come before the join,
    and each title is looked for once.  Raw rows that bring a ``title`` keep it: where
    many articles share a page, the title is best taken from the page beforehand.
    ``many_copies`` says how copies go (``latest_per_key``).
    """
    on_theme = raw.filter(any_starts_with(F.col("themes"), prefix))
    if "title" not in raw.columns:
        on_theme = with_computed(on_theme, "title", title(F.col("extrasXML"), title_tag))
    titled = (
        on_theme.filter(F.length("title") > 0)
        .select(
            F.col("publishDate").alias("date"),
            "ticker",
            F.col("documentIdentifier").alias("url"),
            F.col("tone.tone").alias("tone"),
            F.col("sourceCommonName").alias("source"),
            "title",
        )
    )
    articles = lookup_join(titled, organisations.select("ticker", *keep), ["ticker"])
    columns = ["date", "ticker", "url", "tone", "source", "title", *keep]
    return latest_per_key(articles.select(columns), "ticker", "date", latest, many_copies)


def latest_per_key(
    df: DataFrame,
    key: str,
    date: str,
    n: int = fixed.LATEST_PER_TICKER,
    many_copies: bool = True,
) -> DataFrame:
    """Distinct rows, the ``n`` latest per key; all other columns break ties.

    Two ways to the same rows.  With ``many_copies`` copies meet within each map task and
    every distinct row crosses the network once per task, however hot one row is.  Else
    each map task first cuts a key to its ``n`` latest distinct rows (a dense rank over
    all columns) and one shuffle by key brings those; all copies of a row that is kept
    come along into the key's task, so this is for tables with few copies of a row.
    """
    rest = [F.asc(c) for c in df.columns if c not in (key, date)]
    order = [F.desc(date), *rest]
    if many_copies or n > group_limit(df.sparkSession):
        return top_per_key(df.distinct(), [key], order, n)
    place = F.dense_rank().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("rank", place).filter(F.col("rank") <= n).distinct()


def classify_news(
    model: Model,
    news: DataFrame,
    labels: Labels = fixed.TOPIC_LABELS,
    columns: Sequence[str] = NEWS_COLUMNS,
) -> DataFrame:
    """Labelled topic distribution of each title."""
    return label_distribution(
        distributions(model, news.select(*columns), "title"), labels=labels
    )


def news_scores(
    classified: DataFrame, labels: Labels = fixed.TOPIC_LABELS
) -> DataFrame:
    """Weighted tone per (organisation, topic) and its rank score, not rounded."""
    weighted = stage(weighted_tone(classified, labels=labels), "weighted")
    return rank_score(
        weighted,
        "policy",
        "esg",
        "organisation",
        population=weighted,
        entity="organisation",
        staged=True,
    ).drop("rank")
