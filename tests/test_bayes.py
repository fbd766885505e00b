"""Full-pass variational Bayes against a plain version, at any size and on any cluster."""

from __future__ import annotations

import json
import math
import os
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimscale.operators import bayes_topics as B
from claimscale.operators import dictionary, topic_model
from claimscale.operators.variational import digamma, log_gamma, settle
from claimscale.sources.staging import fresh_path

THEMES = ["water energy carbon climate forest", "board audit director vote shareholder",
          "worker safety union wages training"]


def _texts(n=200):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        words = [w for t in (i % 3, (i // 3) % 3) for w in rng.choice(THEMES[t].split(), 7)]
        rows.append((i, " ".join(words + [f"word{i % 40:03d}"])))
    return rows


@pytest.fixture(scope="module")
def statements(spark):
    rows = _texts() + [(500, "of it 12"), (501, ""), (502, None), (503, "unseen vocabulary")]
    return spark.createDataFrame(rows, "id int, statement string").repartition(5, "id")


@pytest.fixture(scope="module")
def model(statements):
    return B.fit(statements.filter("id < 500"), order=["id"], topics=3, passes=8, tolerance=0)


def test_special_functions():
    x = np.array([0.01, 0.2, 0.5, 1, 1.5, 2, 7.99, 8, 30.5, 1e6])
    assert np.allclose(log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)
    h = 1e-5
    slope = [(math.lgamma(v * (1 + h)) - math.lgamma(v * (1 - h))) / (2 * h * v) for v in x]
    assert np.allclose(digamma(x), slope, rtol=1e-6, atol=1e-6)
    assert abs(digamma(np.array(1.0)) + 0.5772156649015329) < 1e-12


def plain_fit(spark, rows, k, passes, seed=42):
    """The same passes in NumPy, text by text and with the whole matrix at hand."""
    bags = [Counter(w for w in (t or "").split() if len(w) >= 4) for _, t in rows]
    terms = sorted({w for b in bags for w in b}, key=lambda w: (-sum(b[w] for b in bags), w))
    hashed = spark.createDataFrame([(w,) for w in terms], "term string")
    start = {
        r[0]: r[1:]
        for r in hashed.select("term", *[F.xxhash64("term", F.lit(i), F.lit(seed)) for i in range(k)]).collect()
    }
    weights = np.array([[0.5 + (h % 2**32) / 2**32 for h in start[w]] for w in terms])
    prior = 1 / k
    weights = weights + prior
    bounds = []
    for _ in range(passes):
        logs = digamma(weights) - digamma(weights.sum(0))
        sums = np.zeros_like(weights)
        bound = ((prior - weights) * logs).sum() + log_gamma(weights).sum()
        bound -= weights.size * math.lgamma(prior)
        bound += (math.lgamma(prior * len(terms)) - log_gamma(weights.sum(0))).sum()
        for bag in bags:
            if not bag:
                continue
            at = [terms.index(w) for w in bag]
            n = np.array([bag[w] for w in bag], float)
            gamma = np.full(k, prior + n.sum() / k)
            for _ in range(100):
                theta = np.exp(digamma(gamma) - digamma(gamma.sum()))
                phi = theta * np.exp(logs[at])
                new = prior + (phi / phi.sum(1)[:, None] * n[:, None]).sum(0)
                stop = abs(new - gamma).mean() <= 1e-4
                gamma = new
                if stop:
                    break
            theta = digamma(gamma) - digamma(gamma.sum())
            phi = np.exp(theta) * np.exp(logs[at])
            sums[at] += phi / phi.sum(1)[:, None] * n[:, None]
            bound += (n * np.log(phi.sum(1))).sum()
            bound += ((prior - gamma) * theta + log_gamma(gamma)).sum() - k * math.lgamma(prior)
            bound += math.lgamma(k * prior) - math.lgamma(gamma.sum())
        bounds.append(bound)
        weights = sums + prior
    return terms, weights, bounds


def matrix_of(model):
    rows = model.matrix().orderBy("term_id").collect()
    return [r["term"] for r in rows], np.array([r["weights"] for r in rows])


def test_it_is_what_a_plain_version_finds(spark, model):
    terms, weights, bounds = plain_fit(spark, _texts(), 3, 8)
    got_terms, got = matrix_of(model)
    assert got_terms == terms
    assert np.allclose(got, weights, rtol=1e-6, atol=1e-6)
    assert np.allclose(model.bounds, bounds, rtol=1e-9)
    assert np.allclose(model.totals, weights.sum(0), rtol=1e-9)


def test_the_bound_rises_and_themes_part(model):
    rises = np.diff(model.bounds)
    assert len(rises) == 7 and (rises > -1e-6 * abs(model.bounds[0])).all()
    best = {}
    for r in B.topic_terms(model, 5).collect():
        best.setdefault(r["topic_id"], set()).add(r["term"])
    assert sorted(map(sorted, best.values())) == sorted(sorted(t.split()) for t in THEMES)


def test_it_stops_when_the_bound_stands_still(statements):
    known = statements.filter("id < 500")
    assert len(B.fit(known, order=["id"], topics=3, passes=50, tolerance=1e-3).bounds) < 50


def test_large_matrices_are_joined_by_shuffling(spark, statements, model, monkeypatch):
    monkeypatch.setattr(B, "BROADCAST_BYTES", 1)
    monkeypatch.setattr(B, "ROWS_PER_BUCKET", 50)
    monkeypatch.setattr(B, "BLOCK_ROWS", 64)
    known = statements.filter("id < 500")
    other = B.fit(known, order=["id"], topics=3, passes=8, tolerance=0)
    assert np.allclose(matrix_of(other)[1], matrix_of(model)[1], rtol=1e-9)
    shuffled = B.distributions(other, statements)
    plan = shuffled._jdf.queryExecution().toString()
    monkeypatch.undo()
    scored = {r["id"]: r["probabilities"] for r in shuffled.collect()}
    small = {r["id"]: r["probabilities"] for r in B.distributions(model, statements).collect()}
    assert scored.keys() == small.keys()
    assert all(np.allclose(scored[i], small[i], atol=1e-9) for i in small)
    assert "Exchange" in plan


def test_no_text_moves_while_the_matrix_is_small(model, statements):
    plan = B.distributions(model, statements)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1  # the fixture's own
    assert "BroadcastHashJoin" in plan


def test_every_row_is_scored(model, statements):
    clash = statements.withColumns({"a.b": F.col("id") + 1, "row": F.lit("r"), "held": F.lit(1), "at": F.lit(2)})
    scored = B.distributions(model, clash)
    assert scored.columns == [*clash.columns, "probabilities"]
    rows = {r["id"]: r for r in scored.collect()}
    assert len(rows) == 204
    for i, r in rows.items():
        assert sum(r["probabilities"]) == pytest.approx(1.0) and r["a.b"] == i + 1 and r["row"] == "r"
    for i in (500, 501, 502, 503):
        assert rows[i]["probabilities"] == pytest.approx([1 / 3] * 3)
    best = topic_model.score_topics(model, statements).filter("id >= 500").select("topic_id").distinct()
    assert [r[0] for r in best.collect()] == [0]
    assert B.distributions(model, statements.limit(0)).count() == 0
    assert B.distributions(model, scored).columns == scored.columns


def test_saved_and_loaded_with_labels(spark, model, statements):
    path = fresh_path(spark, "bayes")
    labels = [{"topic_id": i, "topic": "E", "policy": f"p{i}"} for i in range(3)]
    topic_model.save_model(model, path, labels)
    other = topic_model.load_model(path)
    topic_model.check_labels(other, topic_model.load_labels(path))
    with pytest.raises(ValueError, match="2 labels for 3 topics"):
        topic_model.save_model(model, path, labels[:2])
    a, b = (
        {r["id"]: r["probabilities"] for r in topic_model.distributions(m, statements).collect()}
        for m in (model, other)
    )
    assert a == b and other.bounds == model.bounds


def test_a_fitted_model_explains_better_than_word_counts(spark, model, statements):
    known = statements.filter("id < 500")
    found = B.log_likelihood(model, known).first()
    words = Counter(w for _, t in _texts() for w in t.split())
    n = sum(words.values())
    entropy = -sum(c / n * math.log(c / n) for c in words.values())
    assert found["tokens"] == n
    assert -found["log_likelihood"] / n < entropy - 0.3
    unfitted = B.fit(known, order=["id"], topics=3, passes=0)
    found = B.log_likelihood(unfitted, known).first()
    assert -found["log_likelihood"] / n > entropy


def test_settled_weights_do_not_depend_on_the_other_texts():
    rng = np.random.default_rng(1)
    terms, n = rng.random((60, 4)), rng.integers(1, 5, 60).astype(float)
    first = np.array([0, 1, 11, 40])
    together, _ = settle(n, terms, first, 0.25)
    for i, (a, b) in enumerate(zip(first, [*first[1:], 60])):
        alone, _ = settle(n[a:b], terms[a:b], np.array([0]), 0.25)
        assert np.allclose(alone[0], together[i], rtol=1e-12)


def test_vocabularies_of_any_size(spark):
    rows = [(i, f"water energy w{i:05d}x") for i in range(300)]
    docs = spark.createDataFrame(rows, "id int, statement string")
    with pytest.raises(ValueError, match="cells"):
        topic_model.fit_topics(docs, order=["id"], topics=2, max_cells=300)
    fitted = B.fit(docs, order=["id"], topics=2, passes=1)
    assert fitted.terms == 302 and fitted.matrix().count() == 302
    assert B.fit(docs, order=["id"], topics=2, passes=1, vocabulary_size=10).terms == 10
    with pytest.raises(ValueError):
        B.fit(docs.select("id", F.lit("of it").alias("statement")))


def test_bags_hold_the_counts_of_known_terms(spark):
    rows = [(1, ["b", "a", "b"]), (2, ["c"]), (3, []), (4, ["a", "x"])]
    tokens = spark.createDataFrame(rows, "id int, tokens array<string>")
    known = dictionary.dictionary(tokens, size=3)
    ids = {r["term"]: r["term_id"] for r in known.collect()}
    assert ids == {"a": 0, "b": 1, "c": 2}
    got = {r["id"]: [tuple(x) for x in r["bag"]] for r in dictionary.term_bags(tokens, known, ["id"]).collect()}
    assert got == {1: [(0, 1), (1, 2)], 2: [(2, 1)], 4: [(0, 1)]}


def test_repeated_and_null_keys_are_one_text_each(spark):
    rows = [(1, "x", ["b", "a", "b", None]), (1, "x", ["a", "c"]), (None, "y", ["a"]), (None, "y", ["b", "a"]),
            (2, None, ["c"]), (3, "z", []), (4, "z", ["unknown"]), (5, "q", None)]
    tokens = spark.createDataFrame(rows, "id int, o string, tokens array<string>").repartition(3)
    known = spark.createDataFrame([("a", 0), ("b", 1), ("c", 1), ("a", 5)], "term string, term_id long")
    bags = dictionary.term_bags(tokens, known, ["id", "o"]).collect()
    got = {(r["id"], r["o"]): [tuple(x) for x in r["bag"]] for r in bags}
    assert got == {(1, "x"): [(0, 2), (1, 3), (5, 2)], (None, "y"): [(0, 2), (1, 1), (5, 2)], (2, None): [(1, 1)]}
    assert len(bags) == 3


def test_terms_of_a_text_move_at_most_once(spark):
    tokens = spark.range(300).selectExpr("id", "split(concat('water energy word', id % 7), ' ') AS tokens")
    known = dictionary.dictionary(tokens)
    for keys in (["id"], ["id", "tokens"]):
        plan = dictionary.term_bags(tokens, known, keys)._jdf.queryExecution().executedPlan().toString()
        # Rows and their terms meet by chunk; texts with keys of their own move no more after that.
        assert "Exchange" not in plan.split("FlatMapCoGroupsInArrow")[0] and "hashpartitioning(chunk" in plan


FIT = """
import json, sys
from claimscale.session import local_session
from claimscale.operators import bayes_topics as B
spark = local_session("fit", sys.argv[1])
rows = [(i, " ".join(f"word{(i * 7 + j * j) % 40:03d}" for j in range(30))) for i in range(200)]
docs = spark.createDataFrame(rows, "id int, statement string").repartition(int(sys.argv[1]))
B.ROWS_PER_BUCKET = 40
model = B.fit(docs, order=["id"], topics=3, passes=4, tolerance=0)
found = model.matrix().orderBy("term_id").collect()
print(json.dumps([r["weights"] for r in found]))
"""


def test_the_model_does_not_depend_on_the_cores():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = []
    for cores in ("2", "8"):
        done = subprocess.run(
            [sys.executable, "-c", FIT, cores], cwd=root, capture_output=True, timeout=300, text=True
        )
        found.append(json.loads(done.stdout.strip().splitlines()[-1]))
    assert found[0] == found[1]


def test_a_bucket_gets_and_gives_a_row_per_term_and_no_more(spark, monkeypatch):
    monkeypatch.setattr(B, "BROADCAST_BYTES", 1)
    docs = spark.range(600).selectExpr("id", "concat('water energy word', id % 7) AS statement")
    met = []
    plain = B._pass_over_texts

    def seen(*given):
        rows = spark.sparkContext.accumulator(0)
        met.append(rows)
        run = plain(*given)

        def counted(texts, logs):
            rows.add(logs.num_rows)
            return run(texts, logs)

        return counted

    monkeypatch.setattr(B, "_pass_over_texts", seen)
    B.fit(docs, order=["id"], topics=2, passes=2, tolerance=0)
    # Nine terms in one bucket of 600 texts, where the texts' 1,800 terms met a row each before.
    assert [rows.value for rows in met] == [9, 9]


def test_known_words_are_told_alike_by_chunks(spark, statements, model, monkeypatch):
    whole = B.log_likelihood(model, statements).first()
    monkeypatch.setattr(B, "BROADCAST_BYTES", 1)
    monkeypatch.setattr(B, "MOST_ROWS", 7)
    monkeypatch.setattr(B, "BLOCK_ROWS", 40)
    plan = B.distributions(model, statements)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "SortMergeJoin" not in plan.split("FlatMapCoGroupsInArrow")[0]
    chunks = B.log_likelihood(model, statements).first()
    assert chunks["tokens"] == whole["tokens"]
    assert chunks["log_likelihood"] == pytest.approx(whole["log_likelihood"], rel=1e-9)
    nothing = B.log_likelihood(model, statements.filter("id > 499")).first()
    assert tuple(nothing) == (0, None)


def test_texts_go_to_their_buckets_once(spark, monkeypatch):
    docs = spark.range(300).selectExpr("id", "concat('water energy word', id % 7) AS statement")
    plans, plain = [], B.stage

    def seen(df, label="stage"):
        if label == "matrix":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, label)

    monkeypatch.setattr(B, "stage", seen)
    B.fit(docs, order=["id"], topics=2, passes=2, tolerance=0)
    moves = [len([x for x in p.splitlines() if "hashpartitioning(bucket" in x and "ENSURE" in x]) for p in plans[1:]]
    # The matrix's rows move in each pass, the texts did too before.
    assert moves == [1, 1]
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_a_title_is_scored_once_for_all_articles_of_its_page(spark, model, tmp_path, monkeypatch):
    from claimscale.plans import news, registered

    pages = [(i, f"u{i}", f"<title>ocean water {i}</title>") for i in range(4)]
    events = [(i, f"2024-01-{i % 28 + 1:02d}", i % 30, float(i % 7)) for i in range(200)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    frame = spark.createDataFrame(events, "event_id long, ts string, user_id long, value double")
    frame.write.parquet(f"{tmp_path}/events.parquet")
    scored, classify = [], news.classify_news
    monkeypatch.setattr(registered, "_fitted", lambda spark, folder: (model, None))
    monkeypatch.setattr(
        news, "classify_news", lambda m, rows, **kw: scored.append(rows.count()) or classify(m, rows, **kw)
    )
    found = registered.modelled_news(spark, str(tmp_path)).collect()
    assert scored == [4]
    assert {r.organisation for r in found} == {f"org_{i}" for i in range(10)}
    assert len(found) == 50 and all(r.is_even_rank for r in found)
