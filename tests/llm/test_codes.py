"""Speculative BPE, vector codes and collocations against plain versions."""

from __future__ import annotations

import hashlib
import json
import random
import re
from collections import Counter

import numpy as np
import pytest
from corpus import empty, frame, rows

from claimscale.llm import collocations, speculative_bpe, vector_codes
from claimscale.llm.registered import tokenizer_path
from claimscale.llm.shipping import ship
from claimscale.sources.staging import stage


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return stage(frame(spark, rows()))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def codec():
    return speculative_bpe.Codec(tokenizer_path())


def flat(texts):
    blobs = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blobs])]).astype(np.int64)
    return np.frombuffer(b"".join(blobs), np.uint8), offsets


# --- BPE -----------------------------------------------------------------------

SIGNS = [*"ab' .,\n\t0é×日　\xa0\x1c|<>aaastmdrevl", "<|endoftext|>", "'s", "  ", "ß", "\r\n"]
SIGNS += [" wort", "'re", "'ll", "'ve", "́", "٣", "½", "Ⅷ", "​", "\U0001f600", "'S"]


def test_ids_and_texts_are_those_of_the_library(codec, library):
    r = random.Random(5)
    texts = ["".join(r.choices(SIGNS, k=r.randint(0, 40))) for _ in range(4000)]
    texts += [t or "" for _, t, *_ in rows()] + ["a" * 3000, "ab" * 999 + " x", " " * 500]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # the second time from memory
        ids, bounds = codec.encode(*flat(texts))
        for text, a, b, right in zip(texts, bounds, bounds[1:], want):
            assert ids[a:b].tolist() == right, repr(text)
    got = codec.decode(ids, bounds)
    assert got == [library.decode(one, skip_special_tokens=False) for one in want]


def test_every_class_of_code_points_is_the_librarys(codec, library):
    points = [c for c in range(0x80, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)}  {chr(c)}'s" for c in points]
    ids, bounds = codec.encode(*flat(texts))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want


def test_a_token_is_proposed_if_merging_gives_it(codec):
    known = codec.vocabulary
    r = random.Random(1)
    for token in r.sample(range(known.size - 1), 2000):
        assert (known.merged(known.bytes[token]) == [token]) == known.usable[token]


def test_pairs_are_compatible_if_merging_leaves_them(codec):
    known = codec.vocabulary
    r = random.Random(2)
    pairs = [(r.randrange(known.size - 1), r.randrange(known.size - 1)) for _ in range(4000)]
    pairs += [(r.randrange(600), r.randrange(600)) for _ in range(4000)]
    a, b = np.array(pairs).T
    good = known.compatible(a, b)
    for x, y, ok in zip(a.tolist(), b.tolist(), good.tolist()):
        if known.usable[x] and known.usable[y]:
            assert (known.merged(known.bytes[x] + known.bytes[y]) == [x, y]) == ok


def test_some_words_fail_and_only_those_are_merged(codec):
    r = random.Random(4)
    words = ["the", "hello"] + ["".join(r.choices("aeinorst", k=9)) for _ in range(200)]
    ids, sizes, merged = codec.vocabulary.words(*flat(words))
    assert 0 < merged < len(words)
    ends = np.cumsum(sizes)
    for word, a, b in zip(words, ends - sizes, ends):
        assert ids[a:b].tolist() == codec.vocabulary.merged(word.encode())


def _small_file(tmp_path, merges):
    letters = speculative_bpe.byte_letters()
    vocab = {c: i for i, c in enumerate(letters)}
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    said = {
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [],
        "normalizer": None, "post_processor": None,
        "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
                          "use_regex": True},
        "decoder": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True,
                    "use_regex": True},
        "model": {"type": "BPE", "dropout": None, "unk_token": None,
                  "continuing_subword_prefix": None, "end_of_word_suffix": None,
                  "fuse_unk": False, "byte_fallback": False, "ignore_merges": False,
                  "vocab": vocab, "merges": [list(m) for m in merges]},
    }
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(said))
    return str(path)


@pytest.mark.parametrize("ordered", [True, False])
def test_other_merge_lists(tmp_path, ordered):
    """Of few letters, where ties abound; one made of parts that come later is merged throughout."""
    from tokenizers import Tokenizer

    merges = [("a", "a"), ("b", "a"), ("aa", "b"), ("aa", "aa"), ("ba", "ba"), ("a", "ba"),
              ("b", "b"), ("aab", "ba"), ("bb", "aa")]
    if not ordered:
        merges = [merges[2], *merges]
        del merges[3]
    path = _small_file(tmp_path, merges)
    codec, library = speculative_bpe.Codec(path), Tokenizer.from_file(path)
    assert codec.vocabulary.speculates == ordered
    r = random.Random(3)
    texts = ["".join(r.choices("aaab ", k=r.randint(0, 30))) for _ in range(3000)]
    ids, bounds = codec.encode(*flat(texts))
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_encoded_and_decoded_rows(spark, docs, library):
    path = tokenizer_path()
    clash = docs.withColumnsRenamed({"content": "ids", "h": "a.b"})
    encoded = speculative_bpe.encode(clash, path)
    assert set(encoded.columns) == set(clash.columns)
    got = speculative_bpe.decode(encoded, path).collect()
    assert len(got) == docs.count()
    both = speculative_bpe.encode(clash, path, decoded="decoded").collect()
    assert sorted(map(repr, both)) == sorted(repr(r) for r in got)
    for row in got:
        text = row["text"] or ""
        assert row["ids"] == library.encode(text, add_special_tokens=False).ids
        assert row["decoded"] == text and row["a.b"] == 1
    assert speculative_bpe.encode(empty(spark), path).count() == 0
    odd = spark.createDataFrame([([64, 99999999, -1, None],), ([],), (None,)], "ids array<int>")
    assert [r["decoded"] for r in speculative_bpe.decode(odd, path).collect()] == ["a", "", None]


def test_other_kinds_of_tokenizers_are_an_error():
    import public_tokenizers

    with pytest.raises(ValueError):
        speculative_bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


# --- vectors -------------------------------------------------------------------


def plain_codes(found, parts, entries, rounds):
    """code, error by vec_id and the codebooks, comparing everything with everything."""
    kept = [r for r in found if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    x = np.floor(np.array([r[1] for r in kept]) * 1024).astype(np.int64)
    x = x.reshape(len(kept), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def nearest():
        far = np.array([[np.square(x[:, p, None] - books[p]).sum(2)] for p in range(parts)])
        return far[:, 0].argmin(2).T, far[:, 0].min(2).T

    for _ in range(rounds):
        entry, _ = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[entry[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(0) // len(mine)
    entry, away = nearest()
    return [
        (r[0], bytes(e.astype(np.uint8)).hex(), int(a.sum())) for r, e, a in zip(kept, entry, away)
    ], books


def _vectors(seed=3, n=700, values=12, spread=(0.01, 3.0)):
    r = random.Random(seed)
    centres = [[r.gauss(0, spread[1]) for _ in range(values)] for _ in range(9)]
    found = []
    for i in range(n):
        c = r.choice(centres)
        found.append((5 * i + 1, [float(np.float32(v + r.gauss(0, spread[0]))) for v in c], i % 4 or None))
    found += [(2000 + i, found[3][1], 1) for i in range(80)]  # copies
    found += [(7, None, 1), (8, [1.0, None] + [0.0] * 10, 2), (9, [float("nan")] + [0.0] * 11, 2)]
    found += [(10, [float("inf")] + [0.0] * 11, 2), (2000, found[4][1], None), (None, found[5][1], 3)]
    return found


@pytest.mark.parametrize("spread", [(0.01, 3.0), (0.5, 0.5), (0.0, 0.001), (1.0, 20000.0)])
def test_codes_are_those_of_comparing_everything(spark, docs, spread):
    found = _vectors(spread=spread)
    schema = "vec_id long, embedding array<float>, label int"
    table = spark.createDataFrame(found, schema).repartition(6)
    table = table.withColumns({"n": table.vec_id, "a.b": table.label, "entries": table.label})
    codes = vector_codes.compress(table, parts=3, entries=64)
    want, books = plain_codes(found, 3, 64, 4)
    got = vector_codes.with_label_errors(codes.rows).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([(r["vec_id"], r["code"], r["error"]) for r in got], key=key) == sorted(want, key=key)
    assert (codes.codebooks == books).all()
    sums = Counter()
    for r in got:
        sums[r["label"]] += r["error"]
    assert all(r["label_error"] == sums[r["label"]] for r in got)
    text = ",".join(str(v) for book in books for e in book for v in e)
    assert vector_codes.codebook_digest(codes.codebooks) == hashlib.sha256(text.encode()).hexdigest()


def test_bounds_spare_comparisons():
    r = np.random.default_rng(1)
    centres = r.integers(-4000, 4000, (40, 8))
    x = centres[r.integers(0, 40, 3000)] + r.integers(-200, 200, (3000, 8))
    history = [x[:64].astype(np.int64)]
    groups = vector_codes.entry_groups(history[0], 16)
    known, worked = vector_codes.first_bounds(len(x), len(groups)), []
    for _ in range(5):
        known, best, count = vector_codes.assign(x, history, groups, known)
        far = vector_codes.squared_distances(x, history[-1])
        assert (known.entry == far.argmin(1)).all() and (best == far.min(1)).all()
        worked.append(count / far.size)
        book = history[-1].copy()
        for e in range(64):
            if (known.entry == e).any():
                book[e] = x[known.entry == e].sum(0) // (known.entry == e).sum()
        history.append(book)
    assert worked[0] >= 1 and max(worked[1:]) < 0.6


def test_a_net_way_is_less_than_steps_added_up():
    history = [np.array([[0, 0], [9, 9]]), np.array([[5, 0], [9, 9]]), np.array([[1, 0], [9, 9]])]
    ways = vector_codes.net_ways(history, [np.array([0]), np.array([1])])
    assert abs(ways[0, 0] - 1) < 1e-6 and abs(ways[1, 0] - 4) < 1e-6 and (ways[:, 1] == 0).all()


def test_odd_vectors(spark):
    schema = "vec_id long, embedding array<double>, label string"
    none = spark.createDataFrame([(1, None, "a")], schema)
    codes = vector_codes.compress(none)
    assert vector_codes.with_label_errors(codes.rows).count() == 0 and codes.codebooks.size == 0
    few = spark.createDataFrame([(2, [0.5, 1.0], "a"), (1, [0.25, 8.0], None)], schema)
    codes = vector_codes.compress(few, parts=2)
    assert sorted(map(tuple, codes.rows.collect())) == [(1, None, "0000", 0), (2, "a", "0101", 0)]
    for bad in ([(1, [1.0], "a"), (2, [1.0, 2.0], "a")], [(1, [1.0, 2.0, 3.0], "a")]):
        with pytest.raises(ValueError):
            vector_codes.compress(spark.createDataFrame(bad, schema), parts=2)
    with pytest.raises(Exception, match="component"):
        vector_codes.compress(spark.createDataFrame([(1, [1e30, 0.0], "a")], schema), parts=2)


# --- phrases -------------------------------------------------------------------


def plain_collocations(found, longest, least, share, top):
    counts, totals = {}, Counter()
    for _, text, lang, _ in found:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            held = counts.setdefault(lang, Counter())
            for m in range(1, longest + 1):
                held.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = [p for p in f if len(p) >= 2 and f[p] >= least]
        gone = set()
        for p in candidates:
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    if 100 * f[p] >= share * f[p[i : i + size]]:
                        gone.add(p[i : i + size])
        best = []
        for p in candidates:
            cuts = [(2000000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if p not in gone:
                best.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("least,share,top", [(2, 80, 2000), (3, 50, 25), (1, 100, 3000)])
def test_collocations_are_those_of_counting_all(spark, docs, least, share, top):
    got = collocations.collocations(docs, least=least, share=share, top=top).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows(), 4, least, share, top)


def test_hot_prefixes_are_spread_and_merged_again(spark, docs, monkeypatch):
    monkeypatch.setattr(collocations, "PART_BYTES", 2000)
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(collocations, "HEAVY_SHARE", 1e-9)
    monkeypatch.setattr(collocations, "MERGE_ROWS", 50)
    got = collocations.collocations(docs, least=2).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows(), 4, 2, 80, 2000)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(empty(spark)).count() == 0
    alone = spark.createDataFrame([(None, None), ("a b", None), ("", "en"), ("... , ", "en")], "text string, lang string")
    assert collocations.collocations(alone).count() == 0
    some = collocations.collocations(alone, least=1).collect()
    assert [tuple(r) for r in some] == [("und", 1, "a b", 1, 1, 1, 2, 1000000)]


def test_products_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    phrases = spark.createDataFrame(
        [("x", 1, "a ", big), ("x", 1, "b ", big), ("x", 2, "a b ", big - 1), ("x", 3, "a b c ", big // 2)],
        "lang string, words int, phrase string, f long",
    )
    two = phrases.filter("words <= 2")
    found = collocations.scored_cuts(two)
    assert [tuple(r) for r in found.collect()] == [("x", "a b ", big - 1, big, big, 999999)]
    assert collocations.without_subsumed(found, phrases).count() == 1
    assert collocations.without_subsumed(found, phrases, share=50).count() == 0
