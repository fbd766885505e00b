from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from corpus import empty, frame, phrase, rows

from claimscale.llm import components as components_of
from claimscale.llm import near_dedup, phrase_automata, repeats, suffix_dedup
from claimscale.llm.components import components
from claimscale.sources.staging import FREE_SHUFFLES, stage, stage_and_free, stage_folder


@pytest.fixture(scope="module")
def docs(spark):
    return stage(frame(spark, rows()))


def groups_of(links, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components_of_random_graphs_and_a_chain(spark):
    r = random.Random(3)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(140)]
    links += [(i, i + 1) for i in range(300, 340)]
    got = components(spark.createDataFrame(links, "u long, v long")).collect()
    nodes = {n for link in links if link[0] != link[1] for n in link}
    assert {g.node: g.component for g in got} == groups_of(links, nodes)
    assert len(got) == len(nodes)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_links_of_one_task_are_stars_before_the_first_step(spark):
    r = random.Random(3)
    u, v = (np.array(r.choices(range(300), k=200)) for _ in range(2))
    nodes, least = components_of.least_reachable(u, v)
    # groups_of knows all numbers up to a bound; those without links are alone.
    assert dict(zip(nodes.tolist(), least.tolist())) == {
        n: c for n, c in groups_of(zip(u.tolist(), v.tolist()), range(300)).items() if n in set(nodes.tolist())
    }
    chain = spark.range(1, 400).selectExpr("id AS u", "id - 1 AS v").coalesce(1)
    folder = Path(stage_folder(spark).removeprefix("file://"))
    before = set(folder.glob("links-*"))
    assert {r.component for r in components_of.stars(chain).collect()} == {0}
    assert len(set(folder.glob("links-*")) - before) == 1


def test_tables_of_numbers_are_few_files(spark):
    """Not one for each shuffle partition, however many a session has."""
    known = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = Path(stage_folder(spark).removeprefix("file://"))
        before = set(folder.glob("links-*"))
        links = spark.range(5_000).selectExpr("id AS u", "id DIV 2 AS v").repartition(211, "u")
        found = {r.node: r.component for r in components_of.components(links).collect()}
    finally:
        for k, value in known.items():
            spark.conf.set(k, value)
    assert found == dict.fromkeys(range(5_000), 0)
    most = 4 * spark.sparkContext.defaultParallelism
    assert all(len(list(f.glob("part-*"))) <= most for f in set(folder.glob("links-*")) - before)


def shingles(text, size):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", small)
    if len(found) < size:
        return {tuple(found)} if found else set()
    return set(zip(*(found[i:] for i in range(size))))


def near_brute(found, size, percent=80):
    sets = {k: shingles(t, size) for k, t, *_ in found}
    keys = sorted(sets)
    links = [
        (a, b)
        for i, a in enumerate(keys)
        for b in keys[:i]
        if sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return sets, groups_of(links, keys)


def unique(found):
    seen = {}
    for row in found:
        if row[0] is not None:
            seen.setdefault(row[0], row)
    return list(seen.values())


@pytest.mark.parametrize("size", [2, 5])
def test_near_groups_against_brute_force(spark, size):
    found = unique(rows())
    got = near_dedup.near_groups(frame(spark, found), size=size).collect()
    sets, component = near_brute(found, size)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        k: (len(sets[k]), component[k], component[k] == k) for k in sets
    }
    assert len(got) == len(found)


def test_a_large_group_of_variants_is_joined_through_its_base(spark):
    """Variants are too far from each other; only the base links them."""
    r = random.Random(8)
    base = phrase(r, 200).split()
    found = [(5000, " ".join(base), "en", "a")]
    for i in range(150):
        words = list(base)
        for j in r.sample(range(200), 8):
            words[j] = f"v{i}x{j}"
        found.append((i, " ".join(words), "en", "a"))
    got = near_dedup.near_groups(frame(spark, found), size=2).collect()
    sets, component = near_brute(found, 2)
    assert {r.doc_id: r.component_id for r in got} == component
    assert set(component.values()) == {0}


def test_variants_about_the_border_keep_all_links(spark):
    """Changed and shortened variants, some linked with the base and some with each other alone."""
    r = random.Random(31)
    base = phrase(r, 160).split()
    few = phrase(r, 12).split()
    found = []
    for i in range(220):
        words = list(base)
        for j in r.sample(range(160), r.randint(2, 16)):
            words[j] = r.choice(few) if i % 3 else f"v{i}x{j}"
        if i % 4 == 0:
            del words[r.randint(125, 160) :]
        found.append((i, " ".join(words), "en", "a"))
    got = near_dedup.near_groups(frame(spark, found), size=2).collect()
    _, component = near_brute(found, 2)
    assert {r.doc_id: r.component_id for r in got} == component
    assert 1 < len(set(component.values())) < 220


def test_null_keys_take_no_part(spark, docs):
    got = near_dedup.near_groups(docs).collect()
    assert len(got) == len(rows())
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2
    assert near_dedup.near_groups(empty(spark)).count() == 0


def test_links_of_all_versions_of_a_document_count(spark):
    """Two different texts under one key, and near copies of each; keys that are leaders."""
    r = random.Random(21)
    found = []
    for i in range(6):
        for version in range(2):
            base = phrase(r, 150).split()
            found.append((10 * i + 5, " ".join(base), "en", "a"))
            for j in range(3):
                words = list(base)
                words[40 * j + 9] = "changed"
                # The smallest key of some groups is a version's, of others a copy's.
                found.append((10 * i + j * 4 + version, " ".join(words), "en", "a"))
    found.append((5, "", "en", "a"))
    sets = [shingles(t, 2) for _, t, *_ in found]
    links = [
        (found[a][0], found[b][0])
        for a in range(len(found))
        for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    component = groups_of(links, {f[0] for f in found})
    assert len(set(component.values())) == 6
    got = near_dedup.near_groups(frame(spark, found), size=2).collect()
    assert Counter((g.doc_id, g.n_shingles, g.component_id, g.kept) for g in got) == Counter(
        (f[0], len(s), component[f[0]], component[f[0]] == f[0]) for f, s in zip(found, sets)
    )


def test_drop_near_copies_keeps_one_of_each_group(spark, docs):
    got = near_dedup.drop_near_copies(docs, size=2)
    assert got.columns == docs.columns
    numbered = list(enumerate(t for _, t, *_ in rows()))
    _, component = near_brute(numbered, 2)
    kept = [r.text for r in got.collect()]
    assert len(kept) == len(set(component.values()))
    assert Counter(t for t in kept if not t) == Counter(t for _, t in numbered if not t)
    assert near_dedup.drop_near_copies(empty(spark)).count() == 0


def test_signatures_estimate_similarity():
    random_ = np.random.default_rng(1)
    a = random_.integers(0, 2**63, 1000, dtype=np.uint64) * np.uint64(2)
    b = np.concatenate([a[:800], random_.integers(0, 2**63, 200, dtype=np.uint64)])
    one, two = near_dedup.signatures([a, b], 512)
    assert abs((one == two).mean() - 800 / 1200) < 0.07
    # Coordinate k + 1 is coordinate k of the ring turned by one place.
    assert near_dedup.signatures([a[:0]], 8).tolist() == [[2**32 - 1] * 8]


def ordered(found):
    return sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


def bytes_brute(found, length):
    seen, out = set(), []
    for key, text, *_ in ordered(found):
        data = (text or "").encode()
        covered, own = bytearray(len(data)), []
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                covered[i : i + length] = b"\1" * length
            else:
                own.append(window)
        seen.update(own)
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = len(re.findall(rb"\x01+", bytes(covered)))
        sha = hashlib.sha256(kept).hexdigest()
        out.append((key, len(data), len(data) - len(kept), spans, sha, kept))
    return Counter(out)


@pytest.mark.parametrize("many", [repeats.MANY_CLASSES, 2])
def test_later_copies_of_byte_strings_go(spark, docs, many):
    """With ``many`` = 2 most anchors take the way of those with very many classes."""
    got = suffix_dedup.remove_repeats(docs, many_classes=many).collect()
    assert (
        Counter(
            (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got
        )
        == bytes_brute(rows(), 50)
    )
    assert all(sum(e - s for s, e in zip(r.starts, r.ends)) == r.n_removed for r in got)


def test_no_task_gets_more_contents_than_shards_hold(spark, monkeypatch):
    """Shards follow the contents, not the session's shuffles; the rows stay."""
    r = random.Random(31)
    base, found = phrase(r, 1_500).split(), []
    for i in range(8):
        words = list(base)
        for j in range(i, 1_500, 24):
            words[j] = f"v{i}x{j}"
        found.append((i, " ".join(words), "en", "a"))
    monkeypatch.setattr(repeats, "SHARD_BYTES", 1_000, raising=False)
    resolve = suffix_dedup._resolve

    def checked(length):
        def run(table):
            assert sum(len(c) for c in table.column("content").to_pylist()) <= 8_000, "too much"
            return resolve(length)(table)

        return run

    monkeypatch.setattr(suffix_dedup, "_resolve", checked)
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = suffix_dedup.remove_repeats(frame(spark, found)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    assert Counter(
        (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got
    ) == bytes_brute(found, 50)


def test_byte_strings_of_another_length(spark):
    found = unique(rows(seed=4))
    got = suffix_dedup.remove_repeats(frame(spark, found), length=24, gram=8).collect()
    assert Counter(
        (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got
    ) == bytes_brute(found, 24)
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_suffix_array_is_in_order():
    r = random.Random(6)
    data = bytes(r.choices(b"ab", k=400)) * 2
    order, rank = suffix_dedup.suffix_array(np.frombuffer(data, np.uint8), 50)
    heads = [(data[i:] + bytes(50))[:50] for i in order]
    assert heads == sorted(heads)
    assert len(set(rank.tolist())) == len(set(heads))


def words_brute(found, length):
    lists = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in found]
    seen = Counter(tuple(w[i : i + length]) for w in lists for i in range(len(w) - length + 1))
    out = []
    for (key, *_), words in zip(found, lists):
        covered = [False] * len(words)
        for i in range(len(words) - length + 1):
            if seen[tuple(words[i : i + length])] > 1:
                covered[i : i + length] = [True] * length
        kept = " ".join(w for w, c in zip(words, covered) if not c)
        sha = hashlib.sha256(kept.encode()).hexdigest()
        out.append((key, len(words), sum(covered), sha, kept))
    return Counter(out)


@pytest.mark.parametrize("many,patterns", [(repeats.MANY_CLASSES, 3), (2, phrase_automata.PATTERNS)])
def test_repeated_passages_go(spark, docs, many, patterns):
    got = phrase_automata.remove_passages(docs, many_classes=many, patterns=patterns).collect()
    assert (
        Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in got)
        == words_brute(rows(), 35)
    )
    assert all(sum(e - s for s, e in zip(r.starts, r.ends)) == r.n_removed for r in got)


def test_passages_of_another_length_and_of_nothing(spark):
    found = unique(rows(seed=9))
    got = phrase_automata.remove_passages(frame(spark, found), length=12, gram=4).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in got) == (
        words_brute(found, 12)
    )
    assert phrase_automata.remove_passages(empty(spark)).count() == 0


def test_tiles_cover_what_all_passages_cover():
    r = random.Random(1)
    for _ in range(200):
        starts = sorted(r.sample(range(80), r.randint(1, 40)))
        cover = lambda s: {i + j for i in s for j in range(7)}
        chosen = phrase_automata.tiles(starts, 7)
        assert set(chosen) <= set(starts) and cover(chosen) == cover(starts)


def test_every_window_has_its_anchor_wherever_it_stands():
    r = random.Random(7)
    texts = [bytes(r.choices(b"ab c", k=r.randint(0, 300))) for _ in range(30)]
    texts += [texts[3] + texts[5], b"xy" * 200]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    units, _ = suffix_dedup.byte_units(np.frombuffer(b"".join(texts), np.uint8), offsets)
    anchor, _, text, first, last = repeats.segments(units, offsets, 20, 6)
    known, covered = {}, defaultdict(int)
    for a, t, f, l in zip(anchor, text, first, last):
        for i in range(f, l + 1):
            assert known.setdefault(texts[t][i : i + 20], a) == a
            covered[t] += 1
    assert dict(covered) == {i: len(t) - 19 for i, t in enumerate(texts) if len(t) >= 20}


def test_contents_of_a_very_frequent_anchor_are_cut_into_a_few_pieces():
    """Not into each of their windows; a window is in one piece, equal ones share its anchor."""
    r = random.Random(11)
    middle = bytes(r.choices(b"abcdefgh", k=24))
    contents = [bytes(r.choices(b"abcdefgh", k=28)) + middle + bytes(r.choices(b"abcdefgh", k=28)) for _ in range(60)]
    contents += [contents[0][:60] + contents[1][60:]]
    n = len(contents)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([5] * n), pa.array(range(n)), pa.array(range(n)), pa.array([1] * n), pa.array(contents, pa.binary())],
        names=["anchor", "seg", "doc", "members", "content"],
    )
    run = repeats._pieces(suffix_dedup.byte_units, 50, 35, suffix_dedup._cut_bytes(50))
    found = pa.Table.from_batches(run(iter([batch]))).to_pylist()
    assert len(found) <= n * 31 / 4
    part_of, covered = {}, Counter()
    for row in found:
        assert row["content"] == contents[row["doc"]][row["first"] : row["first"] + row["span"] + 50]
        for i in range(row["first"], row["first"] + row["span"] + 1):
            covered[row["doc"], i] += 1
            assert part_of.setdefault(contents[row["doc"]][i : i + 50], row["part"]) == row["part"]
    assert covered == Counter((d, i) for d, c in enumerate(contents) for i in range(len(c) - 49))


def test_segments_cross_the_network_once_at_the_end(spark, docs):
    numbered = docs.select(docs.doc_id.cast("long").alias("doc"), "text").dropDuplicates(["doc"])
    found = repeats.stretches(
        stage(numbered, "numbered"), suffix_dedup.byte_units, 50, 20, suffix_dedup._cut_bytes(50),
        suffix_dedup._byte_windows(50), suffix_dedup._resolve(50), earlier_only=True,
    )
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # Spans are small numbers; ends took as much room as starts, and two selects read all twice.
    assert "span#" in plan and "last#" not in plan
    assert plan.count("Relation [anchor") <= 3 and "Union" not in plan
    assert {f.simpleString() for f in found.schema} == {"doc:bigint", "start:int", "end:int"}


def test_what_led_to_the_removed_strings_is_gone(spark, docs):
    """Tables of earlier steps don't lie beside what the texts then need."""
    folder = Path(stage_folder(spark).removeprefix("file://"))
    unique_docs = stage(docs.filter("doc_id is not null").dropDuplicates(["doc_id"]))
    before = set(folder.glob("*"))
    got = suffix_dedup.remove_repeats(unique_docs)
    held = {p.name.split("-")[0] for p in set(folder.glob("*")) - before}
    assert held == {"spans"}
    assert got.count() == unique_docs.count()


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for folder in manager.localDirsString() for f in Path(folder).rglob("shuffle_*.data")}


def test_shuffle_files_go_once_a_table_is_written(spark):
    known, before = spark.conf.get(FREE_SHUFFLES, None), _shuffle_files(spark)
    path = f"{stage_folder(spark)}/freed"
    written = stage_and_free(spark.range(50).repartition(3, "id"), path)
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert sorted(r.id for r in written.collect()) == list(range(50))
    assert spark.conf.get(FREE_SHUFFLES, None) == known


def test_a_full_bitmap_is_set_by_anchors_that_recur(spark, monkeypatch):
    """Beyond its size anchors are counted in finer slots; what two share is still all found."""
    monkeypatch.setattr(repeats, "MOST_BITS", 12)
    r = random.Random(41)
    texts = [bytes(r.choices(b"abcdefgh ", k=2_000)).decode() for _ in range(10)]
    found = [(i, t, "en", "a") for i, t in enumerate(texts)]
    docs = frame(spark, found).withColumnRenamed("doc_id", "doc")
    packed = repeats.recurring_slots(docs, suffix_dedup.byte_units, 50, 20)
    # 1,250 anchors that don't recur, in 4,096 slots: some 190 pairs would meet.
    assert len(packed) == (1 << 12) // 8 and np.unpackbits(packed).sum() <= 80
    found += [(20 + i, t[700:900] + t[:300], "en", "a") for i, t in enumerate(texts)]
    got = suffix_dedup.remove_repeats(frame(spark, found)).collect()
    assert Counter(
        (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got
    ) == bytes_brute(found, 50)


def test_wanted_suffixes_are_in_the_order_of_all():
    r = random.Random(8)
    for size, depth in ((0, 50), (1, 50), (30, 50), (900, 50), (900, 3), (400_000, 24)):
        data = np.frombuffer(bytes(r.choices(b"ab", k=size // 2)) * 2, np.uint8)
        wanted = np.array([r.random() < 0.3 for _ in data], bool)
        order, rank = suffix_dedup.suffix_array(data, depth, wanted)
        assert sorted(order.tolist()) == np.flatnonzero(wanted).tolist()
        heads = [data[i : i + depth].tobytes() for i in order]
        assert heads == sorted(heads)
        assert len(set(rank[wanted].tolist())) == len({h + bytes(depth - len(h)) for h in heads})


def test_contents_leave_in_batches_in_their_order(monkeypatch):
    monkeypatch.setattr(repeats, "BATCH_ROWS", 4)
    texts = [bytes(range(i, i + 100)) for i in range(3)]
    pack = repeats.zstandard.ZstdCompressor().compress
    wanted = [[{"anchor": i, "seg": j, "members": 2, "first": j, "last": j + i} for j in range(n)] for i, n in enumerate((1, 9, 3))]
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("anchor", "seg", "members", "first", "last")]))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([7, 8, 9]), pa.array([pack(t) for t in texts]), pa.array(wanted, kind)], names=["doc", "packed", "wanted"]
    )
    out = list(repeats._contents(suffix_dedup._cut_bytes(50))(iter([batch])))
    assert max(b.num_rows for b in out) <= 8 and len(out) > 1
    want = [(i, w["seg"], 7 + i, 2, texts[i][w["first"] : w["last"] + 50]) for i, ws in enumerate(wanted) for w in ws]
    assert [tuple(row.values()) for row in pa.Table.from_batches(out).to_pylist()] == want
