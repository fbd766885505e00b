from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimscale import fixed
from claimscale.functions import topics as P
from claimscale.operators import aggregates as A
from claimscale.operators import topic_model as M


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            ("a", [0.1, 0.5, 0.2, 0.1, 0.1], 2.0),
            ("a", [0.4, 0.4, 0.1, 0.05, 0.05], -1.0),
            ("b", [0.0, 0.0, 0.0, 0.0, 1.0], 3.0),
            ("b", [0.2, 0.2, 0.2, 0.2, 0.2], None),
            ("c", [0.0, 0.0, 0.0, 0.0, 0.0], 1.0),
            ("d", None, 1.0),
            ("e", [0.7, 0.3], 1.0),
        ],
        "organisation string, probabilities array<double>, tone double",
    )


def test_first_maximum_wins(rows):
    best = rows.filter("tone = -1").select(P.top_topic(F.col("probabilities")))
    assert best.first()[0] == 0
    assert best.dtypes[0][1] == "int"


def test_rows_without_distribution_have_no_topic(rows):
    got = M.with_best_topic(rows).select("organisation").distinct().collect()
    assert {r[0] for r in got} == {"a", "b", "e"}


def test_labels_are_sorted_and_checked(rows):
    shuffled = list(reversed(fixed.TOPIC_LABELS))
    first = rows.select(P.name_positions(F.col("probabilities"), shuffled)[0]).first()[0]
    assert first.asDict() == {
        "probability": 0.1, "topic_id": 0, "topic": "S", "policy": "ethics",
    }
    with pytest.raises(ValueError):
        P.ordered_labels(fixed.TOPIC_LABELS[1:])


def exploded(rows):
    labelled = A.label_distribution(rows)
    return A.explode_topics(labelled)


def as_set(df, *columns):
    return {
        tuple(round(v, 9) if isinstance(v, float) else v for v in r)
        for r in df.select(*columns).collect()
    }


def test_topic_mass_equals_explode_and_group(rows):
    by_explode = exploded(rows).groupBy("topic_id", "organisation").agg(
        F.sum("probability").alias("esg")
    )
    columns = ("organisation", "topic_id", "esg")
    assert as_set(A.topic_mass(rows), *columns) == as_set(by_explode, *columns)


def test_weighted_tone_equals_explode_and_group(rows):
    by_explode = (
        exploded(rows)
        .groupBy("organisation", "policy", "topic", "topic_id")
        .agg(
            F.sum(F.col("probability") * F.col("tone")).alias("weightedTone"),
            F.sum("probability").alias("weights"),
        )
        .withColumn("esg", F.try_divide("weightedTone", "weights"))
    )
    columns = ("organisation", "policy", "topic", "topic_id", "weightedTone", "weights", "esg")
    got = A.weighted_tone(A.label_distribution(rows))
    assert as_set(got, *columns) == as_set(by_explode, *columns)


def test_prefix_filter(spark):
    themes = spark.createDataFrame(
        [(1, ["X", "UNGP_A"]), (2, ["X"]), (3, []), (4, None), (5, [None, "Y"])],
        "id int, themes array<string>",
    )
    kept = themes.filter(P.any_starts_with(F.col("themes"))).collect()
    assert [r["id"] for r in kept] == [1]


def test_sql_functions(spark, rows):
    P.register_sql_functions(spark)
    rows.createOrReplaceTempView("topic_rows")
    got = spark.sql(
        "SELECT top_topic(probabilities) t, top_probability(probabilities) p "
        "FROM topic_rows WHERE tone = 2"
    ).first()
    assert tuple(got) == (1, 0.5)


def test_articles_per_day_groups_days(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (timestamp_ntz'2024-01-01 01:00', 'a'), "
        "(timestamp_ntz'2024-01-01 23:00', 'a') t(date, organisation)"
    )
    got = A.articles_per_day(rows).collect()
    assert [(r["article_count"], str(r["date"])) for r in got] == [(2, "2024-01-01")]


def test_positions_past_the_labels(spark):
    """They keep their probability without a label; sums refuse to drop them."""
    rows = spark.sql("SELECT 'a' AS organisation, array(.1D, .1D, .1D, .1D, .1D, .5D) AS probabilities")
    named = rows.select(P.name_positions(F.col("probabilities")).alias("p")).first()["p"]
    assert [x["probability"] for x in named] == [0.1] * 5 + [0.5]
    assert [x["topic_id"] for x in named] == [0, 1, 2, 3, 4, None]
    with pytest.raises(Exception, match="more positions than the 5 labels"):
        A.topic_mass(rows).collect()
    toned = rows.withColumn("tone", F.lit(1.0))
    with pytest.raises(Exception, match="more positions than the 5 labels"):
        A.weighted_tone(A.label_distribution(toned)).collect()
