from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from corpus import empty, frame, rows

from claimscale.llm import fingerprints, packing, simple8b, token_files
from claimscale.llm.arrow_text import chunks, word_hashes, words
from claimscale.llm.registered import tokenizer_path
from claimscale.llm.tokens import Encoder
from claimscale.sources.staging import fresh_path, stage


@pytest.fixture(scope="module")
def docs(spark):
    return stage(frame(spark, rows()))


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def flat(texts):
    blobs = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blobs])])
    return np.frombuffer(b"".join(blobs), np.uint8), offsets


def test_chunks_cut_between_texts_only():
    texts = ["a" * 10, None, "b" * 90, "", "c"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]).slice(1)
    seen = []
    for part, data, offsets in chunks(iter([batch]), limit=20):
        seen += [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])]
        assert part.num_rows == len(offsets) - 1
    assert seen == [t or "" for t in texts[1:]]


def test_words_follow_the_rule():
    texts = [t or "" for _, t, *_ in rows()] + ["a", "b", " ", "c d"]
    data, offsets = flat(texts)
    starts, ends, first = words(data, offsets)
    got = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    hashes = dict(zip(got, word_hashes(data, starts, ends).tolist()))
    assert len(set(hashes.values())) == len(hashes)
    assert word_hashes(data, starts, ends).tolist() == [hashes[w] for w in got]
    for text, a, b in zip(texts, first, first[1:]):
        assert got[a:b] == re.findall(r"[^\x20\x09-\x0D]+", text)


def test_pieces_give_the_ids_of_whole_texts(reference):
    r = random.Random(5)
    signs = [*"ab' .,\n\t0é×日　\xa0\x1c|<>", "<|endoftext|>", "'s", "  ", "ß", "\r\n", " wort"]
    texts = ["".join(r.choices(signs, k=r.randint(0, 40))) for _ in range(4000)]
    texts += [t or "" for _, t, *_ in rows()]
    encoder = Encoder(tokenizer_path())
    for _ in range(2):  # the second time from memory
        ids, bounds = encoder.encode(*flat(texts))
        for text, a, b in zip(texts, bounds, bounds[1:]):
            assert ids[a:b].tolist() == reference(text), repr(text)


@pytest.mark.parametrize(
    "values",
    [[], [0], [1] * 700, list(range(50000)), [2**63 + 5, 0, 2**64 - 16, 1, 2**60 - 1, 2**60, 2**53 + 1]],
)
def test_simple8b_round_trip(values):
    assert simple8b.decode(simple8b.encode(np.array(values, np.uint64))).tolist() == values


def test_simple8b_packs_small_values_densely():
    assert len(simple8b.encode(np.ones(128 * 100, np.uint64))) < 128 * 100 / 3
    with pytest.raises(ValueError):
        simple8b.decode(bytes(24))


def by_key(found):
    return sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


@pytest.mark.parametrize("segment_ids", [token_files.SEGMENT_IDS, 300])
def test_token_files_round_trip(spark, docs, reference, segment_ids):
    target = fresh_path(spark, "files")
    token_files.write_token_files(docs, target, tokenizer_path(), segment_ids=segment_ids)
    segments = spark.read.parquet(target)
    got = sorted(token_files.read_token_files(segments).collect(), key=lambda r: r.start)
    start = 0
    assert len(got) == len(rows())
    for row, (key, text, *_) in zip(got, by_key(rows())):
        ids = reference(text) + [0]
        assert (row.doc_id, row.start, row.n_tokens) == (key, start, len(ids))
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        start += len(ids)
    sums = token_files.read_token_files(segments, checksums=True).collect()
    assert sorted(r.ids_crc32 for r in sums) == sorted(zlib.crc32(r.ids) for r in got)


def test_token_files_of_nothing(spark):
    target = fresh_path(spark, "files")
    token_files.write_token_files(empty(spark), target, tokenizer_path())
    assert token_files.read_token_files(spark.read.parquet(target)).count() == 0


def test_hilbert_visits_every_cell_in_single_steps():
    cells = np.array([[a, b, c] for a in range(8) for b in range(8) for c in range(8)]).T
    places = packing.hilbert(cells, 3)
    assert sorted(places.tolist()) == list(range(512))
    path = cells[:, np.argsort(places)]
    assert set(np.abs(np.diff(path, axis=1)).sum(0).tolist()) == {1}


def test_packing_holds_every_id_once(spark, docs, reference, monkeypatch):
    monkeypatch.setattr(packing, "PART_BYTES", 4000)
    monkeypatch.setattr(packing, "BORDER_SAMPLE", 2)
    got = packing.pack(docs, tokenizer_path(), length=64).collect()
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == {k for k, *_ in rows()}
    single = {k: t for k, t, *_ in rows() if k not in (None, 100)}
    for key, text in single.items():
        ids, at = np.array(reference(text) + [0], "<u4"), 0
        for r in sorted(pieces[key], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    total = sum(len(reference(t)) + 1 for _, t, *_ in rows())
    assert sum(r.length for r in got) == total
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    short = 0
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 64
        short += at < 64
    assert short <= 8  # the last of each range
    assert packing.pack(empty(spark), tokenizer_path()).count() == 0


def plain_winnow(text, gram=fingerprints.GRAM, window=fingerprints.WINDOW):
    """Kept positions, from the hashes of single grams."""
    if not text:
        return []
    grams = [text[i : i + gram] for i in range(max(len(text) - gram + 1, 1))]
    h = [int(fingerprints.winnow(g)[0][0]) for g in grams]
    kept = []
    for i in range(max(len(h) - window + 1, 1)):
        span = h[i : i + window]
        at = i + max(j for j, x in enumerate(span) if x == min(span))
        if not kept or kept[-1] != at:
            kept.append(at)
    return [(h[i], i) for i in kept]


def test_winnowing_keeps_the_rightmost_least_of_each_window():
    r = random.Random(2)
    texts = [b"", b"a", b"ab" * 300, bytes(r.choices(b"abc", k=700)), b"x" * 79]
    for text in texts:
        hashes, positions = fingerprints.winnow(text)
        assert list(zip(hashes.tolist(), positions.tolist())) == plain_winnow(text)


def test_a_shared_passage_leaves_a_shared_hash():
    r = random.Random(3)
    passage = bytes(r.choices(range(97, 123), k=79))
    for _ in range(20):
        a, b = (bytes(r.choices(range(97, 123), k=300)) for _ in range(2))
        one = fingerprints.winnow(a[:37] + passage + a[37:])[0]
        two = fingerprints.winnow(b[:211] + passage + b[211:])[0]
        assert set(one.tolist()) & set(two.tolist())


def test_edited_likeness_against_brute_force(spark, docs):
    got = fingerprints.edited_likeness(docs).collect()
    ordered = by_key(rows())
    want = []
    for i, (key, text, *_) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, its, nxt = (
            {h for h, _ in plain_winnow(t.encode())} for t in (text, edited, following)
        )
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        sha = hashlib.sha256(edited.encode()).hexdigest()
        want.append((key, len(text), sha, like(own, its), like(own, nxt)))
    assert sorted(
        [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got], key=repr
    ) == sorted(want, key=repr)
    texts = {(k, t or "") for k, t, *_ in rows()}
    by_text = {}
    for r in got:
        text = next((t for k, t in texts if k == r.doc_id and len(t) == r.n_chars), None)
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        pairs = np.frombuffer(base64.b64decode(r.fingerprint), "<u4").reshape(-1, 2)
        assert pairs.tolist() == [list(p) for p in plain_winnow(text.encode())]
    assert fingerprints.edited_likeness(empty(spark)).count() == 0


def test_short_texts_that_share_their_first_half_are_alike():
    r = random.Random(17)
    for n in range(32, 80):
        text, other = ("".join(r.choices("abcdefgh ", k=n)) for _ in range(2))
        own, its = fingerprints.winnow(text.encode()), fingerprints.winnow(other.encode())
        row = fingerprints.compare(1, text, own, other, its, fingerprints.WINDOW)
        assert row[5] > 0


def test_fingerprints_have_hashes_and_positions(spark, docs):
    got = fingerprints.fingerprints(docs).collect()
    assert len(got) == len(rows())
    assert all(len(r.hashes) == len(r.positions) and (r.n_chars > 0) == bool(r.hashes) for r in got)
