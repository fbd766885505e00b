from __future__ import annotations

import pytest

from claimscale.functions import stems
from claimscale.operators import bayes_topics, dictionary

# Pairs that the rules were published with, step by step, and what the later steps leave.
PAIRS = """
caresses caress, ponies poni, ties ti, caress caress, cats cat, feed feed, agreed agre,
plastered plaster, bled bled, motoring motor, sing sing, conflated conflat, troubled troubl,
sized size, hopping hop, tanned tan, falling fall, hissing hiss, fizzed fizz, failing fail,
filing file, happy happi, sky sky, relational relat, conditional condit, rational ration,
valenci valenc, hesitanci hesit, digitizer digit, conformabli conform, radicalli radic,
differentli differ, vileli vile, analogousli analog, vietnamization vietnam, predication predic,
operator oper, feudalism feudal, decisiveness decis, hopefulness hope, callousness callous,
formaliti formal, sensitiviti sensit, sensibiliti sensibl, triplicate triplic, formative form,
formalize formal, electriciti electr, electrical electr, hopeful hope, goodness good,
revival reviv, allowance allow, inference infer, airliner airlin, gyroscopic gyroscop,
adjustable adjust, defensible defens, irritant irrit, replacement replac, adjustment adjust,
dependent depend, adoption adopt, homologou homolog, communism commun, activate activ,
angulariti angular, homologous homolog, effective effect, bowdlerize bowdler, probate probat,
rate rate, cease ceas, controll control, roll roll, generalizations gener, oscillators oscil,
trees tree, say sai, enjoyed enjoi, yyyy yyyy, by by, is is
"""


def test_published_pairs(spark):
    pairs = [tuple(p.split()) for p in PAIRS.replace("\n", " ").split(",")]
    pairs = [p for p in pairs if p[0] != "yyyy"]
    pairs += [("naïveté", "naïveté"), ("word42s", "word42s"), ("", "")]
    terms = spark.createDataFrame([(a,) for a, _ in pairs], "term string")
    got = {r["term"]: r["base"] for r in stems.stems(terms).collect()}
    assert got == dict(pairs)


def test_a_y_is_a_consonant_after_a_vowel_or_at_the_start(spark):
    terms = spark.createDataFrame([("toying",), ("syzygies",), ("yelled",), ("crying",)], "term string")
    got = {r["term"]: r["base"] for r in stems.stems(terms).collect()}
    assert got == {"toying": "toi", "syzygies": "syzygi", "yelled": "yell", "crying": "cry"}


def test_lemmas_are_words_of_the_corpus(spark):
    words = """report reports reporting reported policy policies make making makes box boxes
        firemen fireman larger large news ring bring caches cache mice mouse dres dress es s"""
    terms = spark.createDataFrame([(w,) for w in words.split()], "term string")
    own = spark.createDataFrame([("mice", "mouse"), ("news", "news"), ("geese", "goose")], "term string, base string")
    got = {r["term"]: r["base"] for r in stems.lemmas(terms, own).collect()}
    changed = {
        "reports": "report", "reporting": "report", "reported": "report", "policies": "policy",
        "making": "make", "makes": "make", "boxes": "box", "firemen": "fireman", "larger": "large",
        "caches": "cache", "mice": "mouse", "dress": "dres",
    }
    assert got == {w: changed.get(w, w) for w in words.split()}
    assert stems.lemmas(terms.limit(0)).count() == 0


@pytest.mark.parametrize("bases", [stems.stems, stems.lemmas])
def test_a_vocabulary_of_base_forms(spark, bases):
    rows = [(["report", "reports", "water"],), (["reporting", "water", "water"],)]
    tokens = spark.createDataFrame(rows, "tokens array<string>")
    known = dictionary.dictionary(tokens, bases=bases)
    got = {r["term"]: (r["term_id"], r["base"], r["count"], r["is_first"]) for r in known.collect()}
    assert got == {
        "report": (0, "report", 3, True), "reporting": (0, "report", 3, False),
        "reports": (0, "report", 3, False), "water": (1, "water", 3, True),
    }
    docs = spark.createDataFrame([("reports water",), ("reporting carbon",)], "statement string")
    model = bayes_topics.fit(docs, topics=2, passes=2, bases=stems.stems)
    assert {r["base"] for r in model.matrix().collect()} == {"report", "water", "carbon"}
    assert model.forms == 4
    assert model.terms == 3
    shares = bayes_topics.distributions(model, docs).collect()
    assert all(sum(r["probabilities"]) == pytest.approx(1) for r in shares)
    assert bayes_topics.topic_terms(model, 3).filter("term = 'report'").count() == 2
