"""Stand-ins: the shared test tables in the shapes that the pipelines read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscale.operators.compute import with_computed

TOPICS = 5
DIMENSIONS = 64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_shares(
    df: DataFrame, embedding: str, name: str, n: int = TOPICS, size: int = DIMENSIONS
) -> DataFrame:
    """``df`` with all values of a vector folded into ``n`` groups, as shares.

    A group is the sum of the squares of every n-th value; the eighth powers of the
    groups, divided by their sum, make some shares large.  Each step is worked out once.
    """

    def group(i: int) -> str:
        values = [f"CAST({embedding}[{j}] AS DOUBLE)" for j in range(i, size, n)]
        return " + ".join(f"({v} * {v})" for v in values)

    powers = F.col("_groups")
    for _ in range(3):
        powers = F.transform(powers, lambda x: x * x)
    grouped = with_computed(df, "_groups", F.expr(f"array({', '.join(group(i) for i in range(n))})"))
    raised = with_computed(grouped, "_powers", powers)
    total = sum((F.get("_powers", F.lit(i)) for i in range(n)), F.lit(0.0))
    shares = F.array(*[F.get("_powers", F.lit(i)) / total for i in range(n)])
    return with_computed(raised, name, shares).drop("_groups", "_powers")


def disclosures(spark: SparkSession, folder: str) -> DataFrame:
    """Scored statements: (vec_id, organisation, probabilities)."""
    organisation = F.concat(F.lit("Org_"), F.col("label").cast("string")).alias("organisation")
    rows = with_shares(table(spark, folder, "embeddings"), "embedding", "probabilities")
    return rows.select("vec_id", organisation, "probabilities")


def news(spark: SparkSession, folder: str) -> DataFrame:
    """Articles: (event_id, date, organisation, tone)."""
    return table(spark, folder, "events").select(
        "event_id",
        F.col("ts").alias("date"),
        F.concat(F.lit("org_"), (F.col("user_id") % 10).cast("string")).alias(
            "organisation"
        ),
        (F.col("value") - 100).alias("tone"),
    )


def classified_news(spark: SparkSession, folder: str) -> DataFrame:
    """Articles with a distribution: each takes that of one embedding."""
    vectors = table(spark, folder, "embeddings")
    size = vectors.select(F.count(F.lit(1)).alias("n")).scalar()
    distributions = with_shares(vectors, "embedding", "probabilities")
    distributions = distributions.select("vec_id", "probabilities")
    return (
        news(spark, folder)
        .withColumn("vec_id", F.col("event_id") % size)
        .join(distributions, "vec_id")
    )
