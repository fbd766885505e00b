"""Words and sets that must not be taken for each other."""

from __future__ import annotations

import numpy as np
import pytest

from claimscale.llm import exact_dedup, mixing, near_dedup, phrase_automata, suffix_dedup
from claimscale.llm.arrow_text import word_hashes
from claimscale.llm.shipping import ship


def alternating(n=1024, signs="ab"):
    """The word whose i-th sign is the parity of i's bits, and its complement.

    Sums of powers of any odd number over their places are equal modulo 2 ** 64.
    """
    parity = [bin(i).count("1") % 2 for i in range(n)]
    return "".join(signs[p] for p in parity), "".join(signs[1 - p] for p in parity)


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def test_hashes_of_words_do_not_depend_on_what_stands_around():
    blobs = [b"", b"a", b"aaaaaaaa", b"aaaaaaaab", b"a" * 16, b"a" * 17, *(w.encode() for w in alternating())]
    alone = [int(word_hashes(np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)]))[0]) for b in blobs]
    data = np.frombuffer(b" x ".join(blobs), np.uint8)
    ends = np.cumsum([len(b) + 3 for b in blobs]) - 3
    starts = ends - [len(b) for b in blobs]
    assert word_hashes(data, starts, ends).tolist() == alone
    assert len(set(alone)) == len(alone)
    other = word_hashes(data, starts, ends, seed=1).tolist()
    assert not set(other) & set(alone) and len(set(other)) == len(other)


def test_words_of_equal_sums_are_two_documents(spark):
    one, two = alternating()
    docs = spark.createDataFrame([(1, one), (2, two), (3, "x y"), (4, f"{one} y z"), (5, f"{two} y z")], "doc_id long, text string")
    for size in (1, 2, 5):
        rows = near_dedup.near_groups(docs, size=size).collect()
        parts = {r["doc_id"]: r["component_id"] for r in rows}
        assert parts[1] == 1 and parts[2] == 2 and parts[4] == 4 and parts[5] == 5
        assert all(r["kept"] for r in rows)


def test_passages_that_differ_in_such_a_word_stay(spark):
    one, two = alternating()
    words = [f"w{i}" for i in range(34)]
    texts = [" ".join([*words[:17], w, *words[17:]]) for w in (one, two)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = phrase_automata.remove_passages(docs, with_rest=False).collect()
    assert [r["n_removed"] for r in rows] == [0, 0]
    bytes_ = spark.createDataFrame([(1, alternating(64)[0]), (2, alternating(64)[1])], docs.schema)
    rows = suffix_dedup.remove_repeats(bytes_, with_rest=False).collect()
    a, b = (t.encode() for t in alternating(64))
    shared = {a[i : i + 50] for i in range(15)} & {b[i : i + 50] for i in range(15)}
    assert sum(r["n_removed"] for r in rows) == (0 if not shared else rows[1]["n_removed"])


def test_columns_with_points_in_their_names(spark):
    docs = spark.createDataFrame(
        [(1, "a b c", "s", 5), (2, "a b c", "s", 5), (3, "d e f g", "t", 6)],
        "doc_id long, text string, source string, `a.b` int",
    )
    assert sorted(r["a.b"] for r in exact_dedup.drop_exact_copies(docs).collect()) == [5, 6]
    assert sorted(r["a.b"] for r in near_dedup.drop_near_copies(docs).collect()) == [5, 6]
    assert mixing.mix(docs).columns == docs.columns


def test_many_distinct_texts_need_few_levels(spark, monkeypatch):
    """Buckets come from the bytes: a tiny table and a narrow shuffle don't end in endless levels."""
    monkeypatch.setattr(exact_dedup, "MAX_LEVELS", 4)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        docs = spark.range(2000).selectExpr("id AS doc_id", "concat('text ', id % 1500) AS text")
        rows = exact_dedup.exact_groups(docs, table_bytes=400).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(rows) == 2000 and sum(r["kept"] for r in rows) == 1500
    assert all(r["keep_key"] % 1500 == r["row_key"] % 1500 for r in rows)
