from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from claimscale.operators import topic_model as M
from claimscale.plans import disclosure
from claimscale.sources.staging import fresh_path

WORDS = {
    0: "water energy carbon climate forest",
    1: "board audit director vote shareholder",
}


@pytest.fixture(scope="module")
def statements(spark):
    rows = []
    for i in range(60):
        words = WORDS[i % 2].split()
        rows.append((i, " ".join(words[(i + j) % 5] for j in range(12))))
    rows.append((60, "of it 12"))
    rows.append((61, "unseen vocabulary"))
    return spark.createDataFrame(rows, "id int, statement string").repartition(4, "id")


@pytest.fixture(scope="module")
def model(statements):
    known = statements.filter("id < 60")
    return M.fit_topics(known, order=["id"], topics=2, max_iterations=15)


def as_dict(df):
    return {r["id"]: r["probabilities"] for r in df.select("id", "probabilities").collect()}


def test_distributions(model, statements):
    got = as_dict(M.distributions(model, statements))
    assert len(got) == 62
    for i, p in got.items():
        assert len(p) == 2
        assert sum(p) == pytest.approx(1.0)


def test_unknown_texts_belong_to_all_topics_alike(model, statements):
    scored = {r["id"]: r for r in M.score_topics(model, statements).collect()}
    assert set(scored) == set(range(62))
    assert all(r["probability"] == max(r["probabilities"]) for r in scored.values())
    for i in (60, 61):
        assert scored[i]["probabilities"] == [0.5, 0.5] and scored[i]["topic_id"] == 0


def test_a_term_of_one_statement_is_in_the_vocabulary(spark):
    rows = [(i, "water energy carbon") for i in range(30)] + [(30, "singular water")]
    docs = spark.createDataFrame(rows, "id int, statement string")
    fitted = M.fit_topics(docs, order=["id"], topics=2, max_iterations=1)
    assert "singular" in M._parts(fitted)[0].vocabulary
    with pytest.raises(ValueError, match="cells"):
        M.fit_topics(docs, order=["id"], topics=2, max_cells=7)


def test_labels_travel_with_the_model(model):
    path = fresh_path(SparkSession.active(), "labelled")
    labels = [{"topic_id": i, "topic": "E", "policy": f"p{i}"} for i in (1, 0)]
    M.save_model(model, path, labels)
    assert M.load_labels(path) == labels[::-1]
    M.check_labels(M.load_model(path), M.load_labels(path))
    with pytest.raises(ValueError, match="3 labels for 2 topics"):
        M.save_model(model, path, [*labels, {"topic_id": 2, "topic": "S", "policy": "x"}])


FIT = """
import json, sys
from claimscale.session import local_session
from claimscale.operators import topic_model as M
spark = local_session("fit", sys.argv[1])
rows = [(i, " ".join(f"word{(i * 7 + j * j) % 40:03d}" for j in range(30))) for i in range(200)]
docs = spark.createDataFrame(rows, "id int, statement string").repartition(int(sys.argv[1]))
model = M.fit_topics(docs, order=["id"], topics=3, max_iterations=4)
print(json.dumps(M._parts(model)[1].topicsMatrix().toArray().tolist()))
"""


def test_the_model_does_not_depend_on_the_cores():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = []
    for cores in ("2", "8"):
        done = subprocess.run(
            [sys.executable, "-c", FIT, cores], cwd=root, capture_output=True, timeout=300, text=True
        )
        found.append(json.loads(done.stdout.strip().splitlines()[-1]))
    for a, b in zip(*found):
        assert a == pytest.approx(b, rel=1e-6)


def test_inference_is_planned_once(model, statements):
    scored = M.score_topics(model, statements)
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("translate(lower") == 1


def test_same_seed_same_model_and_reload(spark, model, statements):
    again = M.fit_topics(
        statements.filter("id < 60"), order=["id"], topics=2, max_iterations=15
    )
    path = fresh_path(spark, "model")
    M.save_model(model, path)
    want = as_dict(M.distributions(model, statements))
    for other in (again, M.load_model(path)):
        got = as_dict(M.distributions(other, statements))
        assert all(got[i] == pytest.approx(want[i], abs=1e-6) for i in want)


def test_vocabulary_order(spark):
    rows = spark.createDataFrame([(["b", "a", "c"],), (["c", "a", "b"],), (["d"],)], "tokens array<string>")
    assert M.vocabulary(rows) == ["a", "b", "c", "d"]
    assert M.vocabulary(rows, size=2) == ["a", "b"]


def test_topic_terms(model):
    terms = M.topic_terms(model, 3).collect()
    assert len(terms) == 6
    assert {(r["topic_id"], r["rank"]) for r in terms} == {(t, i) for t in (0, 1) for i in (1, 2, 3)}
    every = set(" ".join(WORDS.values()).split())
    assert {r["term"] for r in terms} <= every


def test_other_text_column_and_view(spark, model, statements):
    titled = statements.withColumnRenamed("statement", "title")
    got = as_dict(M.distributions(model, titled, "title"))
    assert got == as_dict(M.distributions(model, statements))
    statements.createOrReplaceTempView("model_statements")
    M.register_scored_view(spark, model, "model_statements", "scored_view")
    assert spark.sql("SELECT probabilities, * FROM scored_view").count() == 62


def test_initiatives_keep_one_row_per_pair(spark):
    rows = spark.createDataFrame(
        [
            (1, "a", 0, 0.9), (2, "a", 0, 0.9), (3, "a", 0, 0.95), (4, "a", 1, 0.8),
            (5, "b", 0, 0.81), (6, "b", 0, 0.81), (7, "b", 9, 0.99),
        ],
        "id int, organisation string, topic_id int, probability double",
    )
    topics = spark.createDataFrame(
        [(0, "S", "ethics"), (1, "S", "community")], "topic_id int, topic string, policy string"
    )
    got = disclosure.initiatives(rows, topics, ["id"]).collect()
    assert sorted(r["id"] for r in got) == [3, 5]
    assert all(r["policy"] == "ethics" for r in got)
    scores = disclosure.csr_scores(
        rows.withColumn("probabilities", F.array(*[F.lit(0.2)] * 5)), "organisation"
    )
    assert scores.filter("score > 0 and score <= 100").count() == 10


def test_nothing_to_learn_from(spark):
    rows = spark.createDataFrame([("of it",)], "statement string")
    with pytest.raises(ValueError):
        M.fit_topics(rows)
