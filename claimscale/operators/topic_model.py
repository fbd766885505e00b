"""Topic model: vocabulary, fit, distributions, inspection, persistence.

``fit_topics`` fits Spark's own LDA, whose matrix the driver holds; ``bayes_topics.fit``
passes over every text and keeps the matrix as a table.  What scores, describes and
saves a model takes either kind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizerModel, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscale import fixed
from claimscale.functions.text import token_sql
from claimscale.functions.topics import Labels, ordered_labels, top_probability, top_topic
from claimscale.operators import bayes_topics
from claimscale.operators.bayes_topics import BayesTopics
from claimscale.operators.compute import with_computed
from claimscale.operators.dictionary import ranked_terms, term_counts  # noqa: F401
from claimscale.sources.staging import stage

MODEL_INPUT = "_text"
ROWS_PER_PARTITION = 50_000
MAX_CELLS = 250_000_000  # topics x terms; the driver holds some copies of that many doubles
LABEL_SCHEMA = "topic_id int, topic string, policy string"


Model = PipelineModel | BayesTopics


def vocabulary(
    tokens: DataFrame, column: str = "tokens", size: int | None = None
) -> list[str]:
    """The same terms as a list.  The model is that large, so is what is fetched."""
    top = ranked_terms(tokens, column, size).select("rank", "term").collect()
    return [row["term"] for row in sorted(top, key=lambda row: row["rank"])]


def count_vectors(terms: Sequence[str]) -> CountVectorizerModel:
    """Term counter for a given vocabulary.

    ``CountVectorizerModel.from_vocabulary`` hands terms to the JVM one call at a
    time, which takes a minute for a large vocabulary; this hands over one text
    and splits it there.  Tokens hold no line ends.
    """
    if not terms:
        raise ValueError("the texts hold no terms to learn from")
    jvm = SparkSession.active().sparkContext._jvm
    array = jvm.java.util.regex.Pattern.compile("\n").split("\n".join(terms))
    model = CountVectorizerModel._create_from_java_class(
        "org.apache.spark.ml.feature.CountVectorizerModel", array
    )
    return model.setInputCol("tokens").setOutputCol("features")


def fit_topics(
    documents: DataFrame,
    text: str = "statement",
    order: Sequence[str] = (),
    topics: int = len(fixed.TOPIC_LABELS),
    seed: int = fixed.MODEL_SEED,
    max_iterations: int = 10,
    stop_words: Sequence[str] = fixed.STOP_WORDS,
    vocabulary_size: int | None = None,
    subsampling_rate: float = 1.0,
    optimizer: str = "online",
    max_cells: int = MAX_CELLS,
) -> PipelineModel:
    """Fit tokeniser, term counts and LDA; returns one model from text to topics.

    Every iteration draws as many texts as there are (``subsampling_rate`` 1.0), with
    replacement, as Spark's online optimizer does; ``optimizer="em"`` reads each text
    in each iteration.  All terms count unless ``vocabulary_size`` limits them.  The
    model is a matrix in the driver; one of more than ``max_cells`` is an error.

    Every iteration reads the corpus, so the term counts are staged once, as columns.
    Rows are placed by a hash of ``order``, columns that identify a row (without
    them: of the text's terms), and the number of partitions follows the number of
    rows, so the model does not depend on the cluster.
    """
    tokenise = SQLTransformer(
        statement=f"SELECT *, {token_sql(MODEL_INPUT, stop_words)} AS tokens "
        "FROM __THIS__"
    )
    texts = documents.select(*order, F.col(text).alias(MODEL_INPUT))
    tokens = stage(tokenise.transform(texts).select(*order, "tokens"), "tokens")
    terms = term_counts(tokens).count()
    terms = terms if vocabulary_size is None else min(terms, vocabulary_size)
    if topics * terms > max_cells:
        raise ValueError(
            f"{topics} topics x {terms} terms are more than {max_cells} cells: "
            "limit vocabulary_size, raise max_cells, or fit with bayes_topics"
        )
    counts = count_vectors(vocabulary(tokens, size=vocabulary_size))
    place = F.xxhash64(*order) if order else F.xxhash64("tokens")
    features = counts.transform(tokens.withColumn("_place", place))
    features = stage(features.select(*order, "_place", "features"), "features")
    # How a scan is split depends on the cores, so the rows are placed once more.
    partitions = features.count() // ROWS_PER_PARTITION + 1
    features = features.repartition(partitions, "_place").sortWithinPartitions("_place", *order)
    lda = LDA(
        k=topics,
        seed=seed,
        maxIter=max_iterations,
        optimizer=optimizer,
        subsamplingRate=subsampling_rate,
        featuresCol="features",
        topicDistributionCol="distribution",
    ).fit(features.select("features"))
    return PipelineModel([tokenise, counts, lda])


def score_topics(
    model: Model, documents: DataFrame, text: str = "statement"
) -> DataFrame:
    """Add probabilities, probability and topic_id to each row.

    Every row stays; a text without a known word belongs to all topics alike, and
    the first of them is its best.
    """
    return with_best_topic(distributions(model, documents, text))


def with_best_topic(df: DataFrame, distribution: str = "probabilities") -> DataFrame:
    """Add probability and topic_id to rows that have a distribution."""
    p = F.col(distribution)
    return (
        df.withColumn("probability", top_probability(p))
        .filter(F.col("probability") > 0)
        .withColumn("topic_id", top_topic(p))
    )


def distributions(
    model: Model, documents: DataFrame, text: str = "statement"
) -> DataFrame:
    """Add the topic distribution as array<double> ``probabilities``.

    A text without a known word has the flat distribution 1/k.
    """
    if isinstance(model, BayesTopics):
        return bayes_topics.distributions(model, documents, text)
    rows = documents.withColumn(MODEL_INPUT, F.col(text))
    scored = model.transform(rows).select(*documents.columns, "distribution")
    # Inference is by far the dearest step; a filter must not repeat it.
    plain = with_computed(scored, "_plain", vector_to_array("distribution"))
    p = F.col("_plain")
    flat = F.transform(p, lambda x: F.lit(1.0) / F.size(p))
    known = F.when(F.array_max(p) > 0, p).otherwise(flat)
    return plain.withColumn("probabilities", known).drop("distribution", "_plain")


def topic_terms(model: Model, n: int = 10) -> DataFrame:
    """The ``n`` heaviest terms per topic: topic_id, rank, term, weight."""
    if isinstance(model, BayesTopics):
        return bayes_topics.topic_terms(model, n)
    counts, lda = _parts(model)
    described = lda.describeTopics(n)
    # At most n terms per topic; only those are fetched from the vocabulary.
    used = described.select(F.explode("termIndices").alias("i")).distinct().collect()
    words = counts._java_obj.vocabulary()
    terms = described.sparkSession.createDataFrame(
        [(row["i"], words[row["i"]]) for row in used], "term_id int, term string"
    )
    return (
        described.select(
            F.col("topic").alias("topic_id"),
            F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("at", "t"),
        )
        .select(
            "topic_id",
            (F.col("at") + 1).alias("rank"),
            F.col("t.termIndices").alias("term_id"),
            F.col("t.termWeights").alias("weight"),
        )
        .join(terms, "term_id")
        .select("topic_id", "rank", "term", "weight")
    )


def _parts(model: PipelineModel) -> tuple[CountVectorizerModel, LDAModel]:
    counts = next(s for s in model.stages if isinstance(s, CountVectorizerModel))
    lda = next(s for s in model.stages if isinstance(s, LDAModel))
    return counts, lda


def check_labels(model: Model, labels: Labels) -> None:
    """Labels stand for positions: as many as topics, or names would be wrong."""
    k = model.topics if isinstance(model, BayesTopics) else _parts(model)[1].getK()
    if len(ordered_labels(labels)) != k:
        raise ValueError(f"{len(labels)} labels for {k} topics")


def save_model(model: Model, path: str, labels: Labels | None = None) -> None:
    """Save the model and, next to it, the labels of its topics."""
    if labels is not None:
        check_labels(model, labels)
    if isinstance(model, BayesTopics):
        bayes_topics.save(model, path)
    else:
        model.write().overwrite().save(path)
    if labels is not None:
        rows = [(x["topic_id"], x["topic"], x["policy"]) for x in ordered_labels(labels)]
        frame = SparkSession.active().createDataFrame(rows, LABEL_SCHEMA)
        frame.coalesce(1).write.mode("overwrite").json(f"{path}/labels")


def load_labels(path: str) -> list[dict]:
    """The labels that were saved with the model at ``path``."""
    rows = SparkSession.active().read.schema(LABEL_SCHEMA).json(f"{path}/labels").collect()
    return ordered_labels([row.asDict() for row in rows])


def load_model(path: str) -> Model:
    """A saved model of either kind."""
    try:
        return bayes_topics.load(path)
    except AnalysisException:  # no such file there
        return PipelineModel.load(path)


def register_scored_view(
    spark: SparkSession, model: Model, table: str, view: str
) -> None:
    """Offer a table together with its topic distributions to SQL text."""
    distributions(model, spark.table(table)).createOrReplaceTempView(view)
