from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import empty, frame, phrase, rows

from claimscale.llm import language_id, tokens, toxicity
from claimscale.llm.shipping import ship

BAD = ["idiotic", "wretched", "scoundrel", "loathsome"]


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(11)
    found, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        words = phrase(r, r.randint(20, 120)).split()
        if toxic:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(BAD))
        found.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, int(toxic)))
    labels += [(None, 1, 1), (3, 0, None), (99_999, 1, 1), (5, 1, 1)]
    return frame(spark, found), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents_are_told_apart(spark, labelled):
    docs, labels = labelled
    learned = labels.filter(~toxicity.held_out("doc_id"))
    model = toxicity.fit(docs, learned)
    scored = toxicity.score(docs.drop("score"), model)
    got = scored.select("doc_id", "score", toxicity.held_out("doc_id").alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    right = [(r.score >= 0.3) == (r.doc_id % 5 == 0) for r in got if r.out]
    assert len(right) > 60 and sum(right) >= 0.97 * len(right)


def test_scores_of_odd_rows(spark, labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    odd = frame(spark, rows())
    got = toxicity.score(odd, model)
    assert got.columns == [*(c for c in odd.columns if c != "score"), "score"]
    scores = defaultdict(set)
    for r in got.collect():
        assert 0 <= r.score <= 1
        scores[r.text or ""].add(r.score)
    assert all(len(s) == 1 for s in scores.values())
    empty_score = 1 / (1 + math.exp(-model.bias))
    assert list(scores[""]) == [pytest.approx(empty_score)]
    assert toxicity.score(empty(spark), model).count() == 0


def test_drop_toxic_keeps_clean_rows(spark, labelled):
    docs, labels = labelled
    kept = toxicity.drop_toxic(docs, toxicity.fit(docs, labels))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert len(ids) >= 310 and sum(i % 5 == 0 for i in ids) <= 2


def test_without_labels_of_both_kinds(spark, labelled):
    docs, labels = labelled
    none = toxicity.fit(docs, labels.filter("1 = 0"))
    assert {r.score for r in toxicity.score(docs.limit(3), none).collect()} == {0.5}
    clean = toxicity.fit(docs, labels.filter("toxic = 0"))
    assert all(r.score < 0.05 for r in toxicity.score(docs.limit(3), clean).collect())


def test_samples_keep_their_bounds(spark, labelled):
    docs, labels = labelled
    got = toxicity.training_sample(docs, labels, toxic=7, clean=20).collect()
    assert Counter(r.toxic for r in got) == {1: 7, 0: 20}


def test_the_bounds_of_the_sample_leave_scores_where_they_were(spark):
    """Words of both kinds of documents; only their share tells toxic ones."""
    r = random.Random(13)
    found, labels = [], []
    for i in range(1_000):
        toxic = i % 10 == 0
        words = phrase(r, 40).split()
        for _ in range(3):
            # Every sixth clean document looks like a toxic one.
            words.insert(r.randrange(40), r.choice(BAD) if toxic or i % 6 == 1 else "plain")
        found.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(toxic)))
    docs = frame(spark, found)
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")

    def scores(**bounds):
        scored = toxicity.score(docs, toxicity.fit(docs, labels, **bounds))
        return {row.doc_id: row.score for row in scored.collect()}

    whole, few = scores(), scores(clean=200)
    like = [i for i in range(1_000) if i % 10 == 0 or i % 6 == 1]
    mean = lambda s: sum(s[i] for i in like) / len(like)
    assert 0.2 < mean(whole) < 0.7
    assert abs(mean(few) - mean(whole)) < 0.1
    rejected = lambda s: sum(s[i] >= 0.3 for i in range(1_000) if i % 10)
    assert abs(rejected(few) - rejected(whole)) <= 60
    none = toxicity.fit(docs, labels.filter("toxic = 0"), clean=20)
    assert none.bias == pytest.approx(math.log(1 / 901))


LANGUAGES = {"aa": "abcdef ", "bb": "uvwxyz ", "cc": "abcxyz "}


@pytest.fixture(scope="module")
def web(spark):
    r = random.Random(12)

    def text(lang, n):
        return "".join(r.choices(LANGUAGES[lang], k=n))

    docs = [(i, text(lang, 800), lang, "s") for i, lang in enumerate([*LANGUAGES] * 6)]
    docs.append((90, "no language", None, "s"))
    pages = []
    for i in range(90):
        lang = [*LANGUAGES][i % 3]
        tag = f' lang="{lang}-XX"' if i % 4 else ""
        html = f"<html{tag}><style>uvwxyz</style><p>{text(lang, 5 if i % 9 == 0 else 300)}</p>"
        pages.append((i, f"https://www.{lang}{i % 2}.site{i % 3}.{'xx' if i % 3 else 'yy'}/p{i}", html))
    pages += [(200, None, None), (201, "not an address", ""), (None, "http://aa0.site0.yy", "<p>")]
    pages += [pages[4]]
    return frame(spark, docs), spark.createDataFrame(pages, "page_id long, url string, html string"), docs, pages


def plain_identify(docs, pages):
    """The same evidence, page by page."""
    langs = sorted({d[2] for d in docs if d[2]})

    def grams(text):
        data = re.sub(rb"[0-9]", b" ", text.lower().encode())
        return [data[i : i + 3] for i in range(len(data) - 2)]

    def feature(g):
        return ((int.from_bytes(g, "big") * 0x9E3779B1) & 0xFFFFFFFF) >> 16

    counts = {lang: Counter() for lang in langs}
    for _, text, lang, _ in docs:
        if lang:
            counts[lang].update(map(feature, grams(text)))
    logs = {
        lang: (lambda c: lambda f: math.log((c[f] + 0.5) / (sum(c.values()) + 0.5 * 65536)))(c)
        for lang, c in counts.items()
    }

    def share(scores):
        top = max(scores)
        e = [math.exp(s - top) for s in scores]
        return [x / sum(e) for x in e]

    rows_ = []
    for page_id, url, html in pages:
        m = re.match(r"[a-zA-Z][\w+.-]*://([^/?#:@]+)", url or "")
        host = re.sub(r"^(www|m)\.", "", m[1].lower()) if m else ""
        domain = ".".join(host.split(".")[-2:]) if "." in host else ""
        said = re.search(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", html or "")
        found = grams(language_id.visible_text(html))
        weight = min(len(found), 50) / max(len(found), 1)
        text = [weight * sum(logs[lang](feature(g)) for g in found) for lang in langs]
        rows_.append((page_id, host, domain, host.split(".")[-1], said[1] if said else "und", text, share(text)))
    total = lambda pick: [sum(r[6][i] for r in rows_ if pick(r)) for i in range(len(langs))]
    world = total(lambda r: True)
    base = [(w + 0.5) / (sum(world) + 0.5 * len(langs)) for w in world]

    def pulled(n, own, towards):
        left = [max(a - b, 0.0) for a, b in zip(n, own)]
        return [(x + 5 * t) / (sum(left) + 5) for x, t in zip(left, towards)]

    out = []
    for page_id, host, domain, suffix, said, text, p in rows_:
        prior = pulled(total(lambda r: r[2] == domain), p, base)
        prior = pulled(total(lambda r: r[1] == host), p, prior)
        q = [math.log(x) + t for x, t in zip(prior, text)]
        for at, value in ((4, said), (3, suffix)):
            kinds = len({r[at] for r in rows_})
            n = total(lambda r: r[at] == value)
            q = [a + math.log((b + 0.5) / (w + 0.5 * kinds)) for a, b, w in zip(q, n, world)]
        q = share(q)
        best = max(range(len(langs)), key=lambda i: (q[i], -i))
        out.append((page_id, host, said, langs[best], round(max(q), 6)))
    return Counter(out)


def test_identify_against_brute_force(spark, web):
    docs, pages, plain_docs, plain_pages = web
    got = language_id.identify(pages, docs).collect()
    assert Counter(
        (r.page_id, r.host, r.declared, r.language, round(r.probability, 6)) for r in got
    ) == plain_identify(plain_docs, plain_pages)
    right = [r.language == [*LANGUAGES][r.page_id % 3] for r in got if (r.page_id or 999) < 90]
    assert sum(right) >= 0.98 * len(right)


def test_identify_without_pages_or_languages(spark, web):
    docs, pages, *_ = web
    assert language_id.identify(pages.limit(0), docs).count() == 0
    got = language_id.identify(pages, docs.limit(0)).collect()
    assert len(got) == 94 and {r.language for r in got} == {None}


def test_batches_of_long_texts_are_bounded(spark):
    ship(spark)
    texts = spark.range(1_500, numPartitions=1).selectExpr("id", "repeat('0123456789', 2000) AS text")

    def sizes(batches):
        for batch in batches:
            yield batch.from_pydict({"n": [batch.nbytes]})

    found = [row.n for row in texts.mapInArrow(sizes, "n long").collect()]
    assert sum(found) > 1_500 * 20_000 and max(found) < 9 << 20


def test_a_worker_keeps_nothing_of_earlier_steps(spark, labelled):
    """Scoring starts without the texts that a tokenizer's worker remembers."""
    tokens._encoders["a path"] = "what was learned"
    tokens.forget()
    assert not tokens._encoders
    docs, labels = labelled
    scored = toxicity.score(docs.repartition(1), toxicity.fit(docs, labels))
    assert scored.count() == docs.count()


def test_the_driver_weighs_training_rows_in_blocks():
    """The numbers of all rows at once took the driver some 40 bytes an n-gram; the model stays."""
    r = np.random.default_rng(2)
    n, width = 900, 500
    sizes = r.integers(0, 2_000, n)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    column = r.integers(0, width, edges[-1]).astype(np.int32)
    ratio, truth = r.normal(size=width), r.integers(0, 2, n)
    stands_for = np.where(truth == 1, 1.0, 3.5)
    tracemalloc.start()
    weights, bias = toxicity._regress(edges, column, ratio, truth, stands_for)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(column) > 3 * toxicity.BLOCK_HITS and most < 20e6
    owner = np.repeat(np.arange(n), sizes)
    value = ratio[column] / np.sqrt(np.maximum(sizes, 1))[owner]
    known, known_bias, past, past_bias = np.zeros(width), 0.0, np.full(width, 1e-8), 1e-8
    part = stands_for / stands_for.mean()
    for _ in range(toxicity.STEPS):
        z = np.bincount(owner, value * known[column], n) + known_bias
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - truth) * part
        gradient = np.bincount(column, value * error[owner], width) / n + toxicity.RIDGE * known
        past += gradient**2
        known -= toxicity.RATE * gradient / np.sqrt(past)
        past_bias += error.mean() ** 2
        known_bias -= toxicity.RATE * error.mean() / np.sqrt(past_bias)
    assert np.allclose(weights, known, rtol=1e-9, atol=1e-12) and abs(bias - known_bias) < 1e-9
