from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from corpus import empty, frame, rows

from claimscale.llm import exact_dedup, mixing
from claimscale.sources.staging import stage


@pytest.fixture(scope="module")
def docs(spark):
    return stage(frame(spark, rows()))


def test_content_table_probes_past_equal_hashes():
    table = exact_dedup.ContentTable()
    for i in range(500):
        assert table.find(i % 3, b"%d" % i) == -1
        assert table.add(i % 3, b"%d" % i) == i
    assert [table.find(i % 3, b"%d" % i) for i in range(500)] == list(range(500))


@pytest.mark.parametrize("table_bytes", [exact_dedup.TABLE_BYTES, 1500])
def test_exact_groups_against_brute_force(spark, docs, table_bytes):
    """The small table makes buckets overflow, so that levels follow."""
    got = exact_dedup.exact_groups(docs, table_bytes=table_bytes).collect()
    texts = defaultdict(list)
    for key, text, *_ in rows():
        texts[text or ""].append(key)
    assert len(got) == len(rows())
    want = Counter()
    for text, keys in texts.items():
        known = [k for k in keys if k is not None]
        sha = hashlib.sha256(text.encode()).hexdigest()
        for key in keys:
            want[key, max(known, default=None), len(keys), sha] += 1
    assert Counter((r.row_key, r.keep_key, r.group_size, r.sha) for r in got) == want
    kept = Counter(r.sha for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(texts)
    assert all(r.row_key == r.keep_key for r in got if r.kept)


def test_drop_exact_copies_keeps_columns_and_one_of_each(spark, docs):
    got = exact_dedup.drop_exact_copies(docs)
    assert got.columns == docs.columns
    texts = [r.text or "" for r in got.collect()]
    assert sorted(texts) == sorted({t or "" for _, t, *_ in rows()})
    assert exact_dedup.drop_exact_copies(empty(spark)).count() == 0


def sizes(found):
    return [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in found]


def wanted_targets(found):
    """Water level by bisection, apart from the operator's own way."""
    total = defaultdict(int)
    for (_, _, _, source), size in zip(found, sizes(found)):
        total[source] += size
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    low, high = 0.0, 10.0 * sum(total.values()) + 1
    for _ in range(200):
        level = (low + high) / 2
        filled = sum(min(3 * total[s], level * weight[s]) for s in names)
        low, high = (level, high) if filled < sum(total.values()) else (low, level)
    return total, {s: min(3 * total[s], high * weight[s]) for s in names}


def test_mix_meets_its_targets(spark, docs):
    got = mixing.mix_counts(docs).collect()
    found = rows()
    total, target = wanted_targets(found)
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter(
        (k, s, n) for (k, _, _, s), n in zip(found, sizes(found))
    )
    taken, copies = defaultdict(int), Counter((k, t) for k, t, *_ in found)
    for r in got:
        assert r.source_size == total[r.source]
        assert abs(r.target - target[r.source]) < 1e-6 * (1 + target[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    for source, words in taken.items():
        assert -max(copies.values()) <= words - target[source] <= 1e-6
    again = mixing.mix_counts(docs).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_complete_epochs_come_first(spark, docs):
    for r in mixing.mix_counts(docs).collect():
        assert r.taken >= r.epochs * r["size"] and r.extra <= r["size"]


def test_heavier_documents_are_taken_more_often(spark):
    found = [(i, "w " * 10, "en", "a" if i % 2 else "b") for i in range(4000)]
    from pyspark.sql import functions as F

    docs = frame(spark, found)
    heavy = F.when(F.col("doc_id") % 4 < 2, 4.0).otherwise(1.0)
    got = mixing.mix_counts(docs, weights=[1.0, 3.0], weight=heavy).filter("source = 'a'")
    took = Counter(r.doc_id % 4 < 2 for r in got.filter("extra > 0").collect())
    assert took[True] > 1.5 * took[False]


def test_mix_repeats_and_cuts_texts(spark, docs):
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    counted = mixing.mix_counts(docs).collect()
    words = sum(sizes([(0, r.text) for r in mixed.collect()]))
    assert words == sum(r.taken for r in counted)
    whole = {(k, t) for k, t, *_ in rows()}
    cut = [r for r in mixed.collect() if (r.doc_id, r.text) not in whole]
    assert len(cut) <= 7
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mix_counts(empty(spark)).count() == 0
