from __future__ import annotations

import math
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from claimscale.functions import sentences as S
from claimscale.functions import text as T
from claimscale.sources.staging import fresh_path


def _corpus():
    """Firms with "Inc." and "e.g." inside sentences; The and However open them."""
    rows = []
    for i in range(150):
        a, b = f"Firm{chr(97 + i % 26)}{chr(97 + i // 26)}x", f"town{chr(97 + i % 26)}y"
        rows.append(f"The report of {a} Inc. shows growth in {b} again. However many risks remain open there.")
        rows.append(f"However some goods, e.g. water, were dear in {b} then. The board met J. Miller there.")
        rows.append(f"The board of {a} Inc. The report was late in {b} once. However it came.")
        rows.append(f"However nobody at St. Mary knew it in {b} now. The growth was slow!  Was it?")
        rows.append(f"Once again it was now there and then once more it came, now again and there in {b} were then goods that came there again, then and now.")
    return rows


@pytest.fixture(scope="module")
def paragraphs(spark):
    rows = [(i, " ".join(t.split())) for i, t in enumerate(_corpus())] + [(9000, ""), (9001, None)]
    return spark.createDataFrame(rows, "id int, paragraph string").repartition(4)


@pytest.fixture(scope="module")
def known(paragraphs):
    return S.train(paragraphs)


def cut(spark, text, known):
    row = spark.createDataFrame([(text,)], "p string").select(S.split_learned(F.col("p"), known).alias("s"))
    return row.first()["s"]


def test_what_is_learned(known):
    assert {"inc", "e.g", "st"} <= set(known.abbreviations)
    assert not {"again", "there", "then", "once", "now", "water", "it", "report"} & set(known.abbreviations)
    assert {"the", "however"} <= set(known.starters)
    assert "mary" not in known.starters and ("st", "mary") in known.pairs


def test_abbreviations_and_initials_do_not_break(spark, known):
    text = "The firm Inc. paid J. Miller, e.g. in May. However St. Mary did not! Did it? The end."
    assert cut(spark, text, known) == [
        "The firm Inc. paid J. Miller, e.g. in May.", "However St. Mary did not!", "Did it?", "The end.",
    ]
    # An abbreviation may end a sentence: an opening word with a capital follows.
    assert cut(spark, "It was Firm Inc. The board met. So be it.", known) == [
        "It was Firm Inc.", "The board met.", "So be it.",
    ]
    assert cut(spark, "Firm Inc. the board", known) == ["Firm Inc. the board"]
    assert cut(spark, "", known) == [""] and cut(spark, None, known) is None


def test_nothing_learned_is_the_fixed_rule_but_for_initials(spark):
    text = "One a. Two. Three inc. Four! Five? six. "
    want = spark.range(1).select(T.split_sentences(F.lit(text)).alias("s")).first()["s"]
    assert [s for s in cut(spark, text, S.Sentences())] == ["One a. Two."] + want[2:]


def test_scores_are_those_of_counting_one_by_one(paragraphs):
    words = []
    for text in _corpus():
        line = [re.sub("[^a-z0-9.]+$", "", re.sub("^[^a-z0-9]+", "", w.lower())) for w in text.split()]
        words += [(re.sub(r"\.$", "", w), w.endswith(".")) for w in line]
    stopped, open_ = Counter(w for w, s in words if s), Counter(w for w, s in words if not s)
    n, n_stopped = len(words), sum(stopped.values())

    def log_of(p):
        return math.log(min(max(p, 1e-12), 1 - 1e-12))

    want = {}
    for w in stopped:
        a, b = stopped[w], open_[w]
        p = n_stopped / n
        null = a * log_of(p) + b * log_of(1 - p)
        always = a * log_of(0.99) + b * log_of(1 - 0.99)
        signs = len(w.replace(".", ""))
        want[w] = -2 * (null - always) * math.exp(-signs) * (w.count(".") + 1) * signs ** -b
    got = {
        r["word"]: r["score"]
        for r in S.abbreviation_scores(S.word_stops(S.word_places(paragraphs, "paragraph"))).collect()
    }
    assert got.keys() == {w for w in want if re.search("[a-z]", w)}
    assert all(got[w] == pytest.approx(want[w], rel=1e-9, abs=1e-300) for w in got)


def test_lists_are_bounded_by_their_best(paragraphs):
    few = S.train(paragraphs, most=1)
    assert len(few.abbreviations) == len(few.starters) == 1


def test_saved_and_loaded(known):
    path = fresh_path(S.SparkSession.active(), "sentences")
    S.save(known, path)
    assert S.load(path) == known


def test_statements_by_learned_sentences(spark, known):
    text = "The firm Inc. paid well. However St. Mary did not."
    docs = spark.createDataFrame([(1, text)], "id int, body string")
    rows = T.explode_statements(docs, "body", ["id"], 5, lambda p: S.split_learned(p, known)).collect()
    assert [(r["sentence_no"], r["statement"]) for r in rows] == [
        (0, "The firm Inc. paid well."), (1, "However St. Mary did not."),
    ]


def test_nothing_to_learn_from(spark, paragraphs):
    assert S.train(paragraphs.limit(0)) == S.Sentences()


def test_paragraphs_are_counted_once_and_without_patterns_per_word(spark):
    rows = [("",), (None,), ("  ",), ("a",), (" ... Inc. (the) e.g.  --- x--y-- .",), ("..",), ("É. a-. (B.)",)]
    places = S.word_places(spark.createDataFrame(rows, "t string"), "t")
    got = sorted((r["word"], r["stopped"], r["next"] or "") for r in places.collect())
    words = [["a"], ["", "inc.", "the", "e.g.", "", "x--y", ""], [""], ["", "a-.", "b."]]
    want = []
    for line in words:
        types = [w.removesuffix(".") for w in line]
        want += [(t, w.endswith("."), n) for t, w, n in zip(types, line, [*types[1:], ""])]
    assert got == sorted(want)
    plan = places._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 4  # a word had eight or more of its own


def test_counted_places_say_what_places_say(paragraphs):
    places = S.word_places(paragraphs, "paragraph")
    assert sorted(S.stops_of(S.place_counts(places)).collect()) == sorted(S.word_stops(places).collect())


def test_a_long_paragraph_is_cut_once(spark, known):
    text = " ".join(f"Firm {i} paid well and so did the other firms, St. Mary said." for i in range(8000))
    begun = time.monotonic()
    assert len(cut(spark, text, known)) == 8000
    assert time.monotonic() - begun < 30  # each piece cut the whole paragraph again, in the square of its length


def test_lists_longer_than_twenty_thousand_stay_whole(spark):
    n = 20_500
    # Two letters and a point within: an abbreviation once it stands before a full stop often.
    word = F.concat(F.lit("q."), F.conv(F.col("id") + 36**3, 10, 36))
    rows = spark.range(n).select(F.lower(word).alias("word"), F.lit(True).alias("stopped"), F.lit(None).cast("string").alias("next"))
    much = spark.sql("select 'open' as word, false as stopped, cast(null as string) as next, 3000000L as n")
    counted = rows.withColumn("n", F.lit(3000).cast("long")).unionByName(much)
    scored = S.abbreviation_scores(S.stops_of(counted)).filter(f"score >= {S.fixed.ABBREVIATION_SCORE}")
    assert scored.count() == n  # the case is one of more entries than were kept
    whole, original = [], S.place_counts
    S.place_counts = lambda places: counted
    try:
        shortened, _, _ = S.scores(spark.createDataFrame([("a",)], "paragraph string"))
        whole = shortened.select("word").distinct().count()
    finally:
        S.place_counts = original
    assert whole == n


def test_lists_as_tables_cut_as_lists_in_the_plan_do(spark, paragraphs):
    docs = [(i, t) for i, t in enumerate(_corpus()[:60])] + [
        (7, "It was Firm Inc. The board met. So be it."), (None, "J. Miller came. K. went. Firm Inc. paid e.g. all."),
        (None, "J. Miller came. K. went. Firm Inc. paid e.g. all."), (8, ""), (9, None), (10, "Inc."), (11, "a. b. c."),
        (12, "Firm Inc. the St. Mary Inc. However St. Mary won. St. The end! Inc. The? e.g. However"),
    ]
    table = spark.createDataFrame(docs, "id int, body string").repartition(3)
    got = {}
    for plan_bytes in (S.PLAN_BYTES, 0):
        rule = S.rule(paragraphs, plan_bytes=plan_bytes)
        assert (rule.mark is None) == (plan_bytes > 0)
        rows = T.explode_statements(table, "body", ["id"], 1, rule.split, rule.mark)
        assert rows.columns == ["id", "paragraph_no", "sentence_no", "statement"]
        got[plan_bytes] = sorted((str(r["id"]), *r[1:]) for r in rows.collect())
    assert got[0] == got[S.PLAN_BYTES] and len(got[0]) > 60
