from __future__ import annotations

import math
import sys
import unicodedata

import numpy as np
import pytest

from claimscale.functions import folding
from claimscale.operators import bayes_topics, dictionary
from claimscale.operators import topic_map as M


@pytest.fixture(scope="module")
def terms(spark):
    rng = np.random.default_rng(2)
    rows = [(f"w{i:03d}", int(rng.integers(1, 90)), [float(v) for v in rng.gamma(0.4, size=4) + 1e-4]) for i in range(300)]
    rows.append(("own", 40, [40.0, 1e-4, 1e-4, 1e-4]))
    return rows, spark.createDataFrame(rows, "term string, count long, weights array<double>")


def shares(rows):
    w = np.array([r[2] for r in rows])
    return w / w.sum(0)


def test_relevance(terms):
    rows, table = terms
    p, n = shares(rows), sum(r[1] for r in rows)
    got = {}
    for r in M.relevant_terms(table, 4, 5).collect():
        got.setdefault(r["topic_id"], []).append((r["rank"], r["term"], r["share"], r["lift"], r["relevance"]))
    for k in range(4):
        scored = []
        for (term, count, _), share in zip(rows, p[:, k]):
            lift = share / (count / n)
            scored.append((-round(0.6 * math.log(share) + 0.4 * math.log(lift), 9), term, share, lift))
        for (rank, term, share, lift, relevance), (i, want) in zip(sorted(got[k]), enumerate(sorted(scored)[:5], 1)):
            assert (rank, term) == (i, want[1])
            assert [relevance, share, lift] == pytest.approx([-want[0], want[2], want[3]])
    usual = M.relevant_terms(table, 4, 1, weight=1.0).filter("topic_id = 0").first()
    assert usual["term"] == "own"


def test_distances_and_places(spark, terms):
    rows, table = terms
    p = shares(rows)
    for r in M.topic_distances(table, 4).collect():
        a, b = p[:, r["topic_a"]], p[:, r["topic_b"]]
        m = (a + b) / 2
        want = math.sqrt(((a * np.log2(a / m)).sum() + (b * np.log2(b / m)).sum()) / 2)
        assert r["distance"] == pytest.approx(want)
    places = M.topic_map(table, 4).collect()
    assert sum(r["share"] for r in places) == pytest.approx(1)
    flat = np.array([[0.0, 3, 4], [3, 0, 5], [4, 5, 0]])  # lies in a plane: kept exactly
    at = M.scaled_places(flat)
    assert np.allclose(np.linalg.norm(at[:, None] - at[None], axis=2), flat)
    assert M.scaled_places(np.zeros((1, 1))).shape == (1, 2)
    one = spark.createDataFrame([("a", 1, [2.0])], table.schema)
    assert M.topic_distances(one, 1).count() == 0 and M.topic_map(one, 1).count() == 1


def test_a_fitted_model_has_a_map(spark):
    docs = spark.createDataFrame([("water energy carbon",), ("board audit vote",)] * 20, "statement string")
    model = bayes_topics.fit(docs, topics=2, passes=5)
    assert M.topic_distances(model.matrix(), 2).first()["distance"] > 0.5
    assert M.relevant_terms(model.matrix(), 2, 3).count() == 6


def test_folding_covers_all_decompositions(spark):
    signs = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    signs = [s for s in signs if unicodedata.category(s) != "Cn" and s.lower() == s]
    terms = [("x" + "".join(signs[i : i + 40])) for i in range(0, len(signs), 40)]
    terms += ["ﬁnanz", "½", "Ｆｕｌｌ", "がぎ", "한국", "ÉCOLE", "naïve", "plain", "ό", "i̇"]
    table = spark.createDataFrame([(t,) for t in terms], "term string")
    got = {r["term"]: r["base"] for r in folding.folded_terms(table).collect()}
    assert len(got) == len(terms)
    for term in terms:
        want = unicodedata.normalize("NFKD", term.lower())
        assert got[term] == "".join(c for c in want if not unicodedata.combining(c)), term
    assert got["ﬁnanz"] == "finanz" and got["Ｆｕｌｌ"] == "full" and got["がぎ"] == "かき"


def test_a_folded_vocabulary(spark):
    tokens = spark.createDataFrame([(["école", "ecole", "été"],)], "tokens array<string>")
    known = dictionary.dictionary(tokens, bases=folding.folded_terms).collect()
    assert {(r["term"], r["base"], r["count"]) for r in known} == {
        ("école", "ecole", 2), ("ecole", "ecole", 2), ("été", "ete", 1),
    }
