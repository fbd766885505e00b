"""Near-duplicate documents: circulant MinHash, banding, exact verification.

Two permutations give a whole signature: the first scatters the shingles over a
ring, the second ranks the places of the ring, and coordinate k ranks them after a
shift by k.  The ranks of one shingle under all shifts are one stretch of the
second permutation, so a signature is a minimum over stretches.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscale.llm.arrow_text import chunks, lower_ascii, mixed, word_hashes, words
from claimscale.llm.components import components, stars
from claimscale.llm.rows import row_key, with_row_ids
from claimscale.sources.staging import stage, stage_few

RING = 1 << 20
ROWS = 5
BANDS = 32  # a pair at a Jaccard similarity of 0.8 shares no band once in 300,000 times
PERCENT = 80
BLOCK = 64
MORE_LEADERS = 16
SEED = 5

_SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


@lru_cache(maxsize=2)
def _permutations(seed: int, shifts: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each shingle starts in the ring of ranks, and the stretches of that ring."""
    random = np.random.Generator(np.random.PCG64(seed))
    scatter = random.permutation(RING).astype(np.uint32)
    ranks = random.permutation(RING).astype(np.uint32)
    ring = np.concatenate([ranks, ranks[:shifts]])
    return scatter, np.lib.stride_tricks.sliding_window_view(ring, shifts)


def shingle_hashes(
    data: np.ndarray, offsets: np.ndarray, size: int, seed: int = 0
) -> Iterator[np.ndarray]:
    """For each text the distinct 64-bit hashes of its shingles of ``size`` words.

    Words are lower-cased in A-Z.  A text with fewer words is one shingle, one
    without words has none.
    """
    data = lower_ascii(data)
    starts, ends, first = words(data, offsets)
    h = word_hashes(data, starts, ends, seed)
    joined = h.copy()
    for i in range(1, size):
        joined[:-i] = mixed(joined[:-i] * np.uint64(0x9FB21C651E98DF25) + h[i:])
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            yield np.unique(joined[a : b - size + 1])
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for i in range(a, b):
                whole = mixed(whole * np.uint64(0xD1342543DE82EF95) + h[i : i + 1])
            yield whole
        else:
            yield np.zeros(0, np.uint64)


def signatures(sets: list[np.ndarray], shifts: int, seed: int = SEED) -> np.ndarray:
    """One row of ``shifts`` coordinates per set; those of an empty set are the largest number."""
    scatter, stretches = _permutations(seed, shifts)
    out = np.full((len(sets), shifts), np.iinfo(np.uint32).max, np.uint32)
    sizes = np.array([len(s) for s in sets])
    places = scatter[(np.concatenate(sets) >> np.uint64(44)).astype(np.int64)]
    owner = np.repeat(np.arange(len(sets)), sizes)
    step = 1 << 14
    for i in range(0, len(places), step):
        mine = owner[i : i + step]
        heads = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        least = np.minimum.reduceat(stretches[places[i : i + step]], heads, axis=0)
        out[mine[heads]] = np.minimum(out[mine[heads]], least)
    return out


def _sign(size: int, bands: int, rows: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches):
            sets = list(shingle_hashes(data, offsets, size))
            signed = signatures(sets, bands * rows, seed).astype(np.uint64)
            keys = np.tile(np.arange(bands, dtype=np.uint64), (len(sets), 1))
            for r in range(rows):
                keys = mixed(keys * np.uint64(0x9FB21C651E98DF25) + signed[:, r::rows])
            counts = np.array([len(s) for s in sets])
            a = np.array([np.add.reduce(s, dtype=np.uint64) for s in sets], np.uint64)
            # Other hashes of the same shingles: both together tell sets apart by 128 bits.
            again = shingle_hashes(data, offsets, size, seed=1)
            b = np.array([np.bitwise_xor.reduce(mixed(s)) for s in again], np.uint64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, keys.size + 1, bands), pa.int32()),
                pa.array(keys.ravel().view(np.int64)),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(a.view(np.int64)),
                    pa.array(b.view(np.int64)),
                    lists,
                ],
                names=[f.split()[0] for f in _SIGNED.split(", ")],
            )

    return run


_LOWER = bytes(range(256)).translate(
    bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
)


def shingle_set(text: bytes | None, size: int) -> set:
    """The shingles themselves, for exact comparison."""
    found = (text or b"").translate(_LOWER).split()
    if len(found) < size:
        return {tuple(found)} if found else set()
    return set(zip(*(found[i:] for i in range(size))))


def _verify(size: int, percent: int):
    """One leader and some members: which of them are linked with it."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("is_leader", "descending")]).to_pylist()
        leader = shingle_set(rows[0]["text"], size)
        found = []
        for row in rows[1:]:
            other = shingle_set(row["text"], size)
            common = len(leader & other)
            found.append(100 * common >= percent * (len(leader) + len(other) - common))
        return pa.table(
            [
                pa.array([rows[0]["doc_id"]] * len(found), pa.int64()),
                pa.array([row["doc_id"] for row in rows[1:]], pa.int64()),
                pa.array(found, pa.bool_()),
            ],
            names=["leader", "member", "linked"],
        )

    return run


def _tokens(size: int):
    """One row for each hashed shingle of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches, limit=1 << 20):
            sets = list(shingle_hashes(data, offsets, size))
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            rows = batch.select(["rep", "family", "n_shingles"]).take(pa.array(owner))
            token = pa.array(np.concatenate(sets).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, token], names=["rep", "family", "n_shingles", "token"]
            )

    return run


def compared(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Compare the full shingle sets of all ``pairs`` (leader, member).

    Returns leader, member, linked.  ``texts`` holds doc_id, text.  A leader meets its
    members in blocks, so a task holds one leader's set and one member's at a time,
    however many there are.
    """
    blocks = pairs.groupBy("leader").agg((F.count(F.lit(1)) / BLOCK).cast("long").alias("last"))
    members = pairs.join(blocks, "leader").select(
        "leader",
        F.pmod(F.xxhash64("member"), F.col("last") + 1).alias("block"),
        F.col("member").alias("doc_id"),
        F.lit(False).alias("is_leader"),
    )
    leaders = blocks.select(
        "leader",
        F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("block"),
        F.col("leader").alias("doc_id"),
        F.lit(True).alias("is_leader"),
    )
    text = F.col("text").cast("binary").alias("text")
    return (
        members.unionByName(leaders)
        .join(texts, "doc_id")
        .select("leader", "block", "doc_id", "is_leader", text)
        .groupBy("leader", "block")
        .applyInArrow(_verify(size, percent), "leader long, member long, linked boolean")
    )


def may_be_linked(n: Column, at: Column, other_n: Column, other_at: Column, percent: int) -> Column:
    """Whether two sets may be linked whose first common shingle stands at these places.

    Both are read in one order, so no common shingle comes earlier, and the places left
    bound what the sets share.
    """
    most = F.least(n - at, other_n - other_at)
    return (100 + percent) * most >= percent * (n + other_n)


def rare_buckets(
    members: DataFrame, leaders: DataFrame, texts: DataFrame, size: int, percent: int
) -> DataFrame:
    """Smaller buckets that still hold every pair of ``members`` that may be linked.

    Members that share buckets, directly or over others, are a family.  Its shingles are
    ordered by how many of its members hold them, the rarest first, and a member has a
    bucket for each shingle early enough to be the first one that it shares with a text
    similar to it.  So any two that are linked meet in the bucket of their first common
    shingle, at places that ``may_be_linked`` accepts; variants of one text, which share
    nearly all the frequent shingles, mostly meet nowhere.  Shingles that one member alone
    holds come first of all and need no bucket.
    """
    ties = members.join(leaders.select("bucket", "leader"), "bucket")
    family = components(ties.select(F.col("leader").alias("u"), F.col("rep").alias("v")))
    here = members.select("rep", "n_shingles", "rank", "label").distinct()
    here = here.join(
        family.select(F.col("node").alias("rep"), F.col("component").alias("family")), "rep"
    )
    here = stage_few(here, "open")
    read = here.join(texts.withColumnRenamed("doc_id", "rep"), "rep")
    tokens = stage(
        read.select("rep", "family", "n_shingles", "text").mapInArrow(
            _tokens(size), "rep long, family long, n_shingles long, token long"
        ),
        "tokens",
    )
    held = tokens.groupBy("family", "token").agg(F.count(F.lit(1)).alias("held"))
    common = tokens.join(held.filter("held > 1"), ["family", "token"])
    own = Window.partitionBy("rep")
    alone = F.col("n_shingles") - F.count(F.lit(1)).over(own)
    place = F.row_number().over(own.orderBy("held", "token")) - 1
    common = common.withColumn("at", alone + place).filter(
        100 * (F.col("n_shingles") - F.col("at")) >= percent * F.col("n_shingles")
    )
    return common.join(here.drop("n_shingles", "family"), "rep").select(
        F.xxhash64("family", "token").alias("bucket"), "rep", "n_shingles", "at", "rank", "label"
    )


def near_groups(
    docs: DataFrame,
    key: str = "doc_id",
    size: int = 5,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    seed: int = SEED,
) -> DataFrame:
    """Groups of near-duplicate documents.

    A document is the set of its distinct shingles of ``size`` words (words are
    runs of `[^\\x20\\x09-\\x0D]`, lower-cased in A-Z; a text with fewer words is one
    shingle).  Two are linked when 100 * intersection >= ``percent`` * union.

    Returns one row per row of ``docs``: doc_id (the key), n_shingles long,
    component_id (smallest key reachable over links), kept boolean (doc_id =
    component_id).  Null or empty texts have no shingles and are linked with
    nothing.  Rows with a null key take no part: component_id null, kept true.
    Rows that repeat a key are versions of one document: links of any of them
    count, and all have one component_id.  An empty table gives no rows; other columns
    are not read.
    """
    read = docs.select(F.col(key).cast("long").alias("doc_id"), "text")
    keyed, keys = read.agg(F.count("doc_id"), F.count_distinct("doc_id")).first()
    options = {"size": size, "percent": percent, "bands": bands, "rows": rows, "seed": seed}
    if keyed == keys:
        return _groups(read, **options)
    read, row = with_row_ids(read)
    number = F.when(F.col("doc_id").isNotNull(), F.col(row))
    groups = _groups(read.select(number.alias("doc_id"), "text"), **options)
    groups = groups.select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("part"))
    groups = groups.join(read.select(F.col(row).alias("row"), "doc_id"), "row", "left")
    groups = stage(groups, "versions")
    # Versions of one document tie the groups that they are in.
    within = groups.filter("doc_id is not null").select("doc_id", "part").distinct()
    first = within.groupBy("doc_id").agg(F.min("part").alias("v"))
    tied = components(within.join(first, "doc_id").select(F.col("part").alias("u"), "v"))
    within = within.join(tied.withColumnRenamed("node", "part"), "part", "left").select(
        "doc_id", F.coalesce("component", "part").alias("part")
    )
    least = within.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    component = within.distinct().join(least, "part").select("doc_id", "component_id")
    return groups.join(component, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _groups(
    read: DataFrame, size: int, percent: int, bands: int, rows: int, seed: int
) -> DataFrame:
    """``near_groups`` of doc_id and text, where no two rows have one doc_id (but null).

    Equal sets are one class from the start.  Within a band's bucket a leader, the
    member that shares most buckets, is compared with all members that no link joins
    to it yet.  After the first round the buckets that are not joined are cut finer,
    without parting members that may be linked (``rare_buckets``); then rounds go on,
    where leaders leave their bucket and come 16 times as many each time, until the
    members left in every bucket are joined.  So every pair that shares a band is
    compared, known to be joined or known to be too far apart, and a group of
    thousands costs comparisons by its members, not by their square.
    """
    signed = stage(read.mapInArrow(_sign(size, bands, rows, seed), _SIGNED), "signed")
    same = ["set_a", "set_b", "n_shingles"]
    classes = stage(
        signed.filter("n_shingles > 0 and doc_id is not null")
        .groupBy(*same)
        .agg(F.min("doc_id").alias("rep"), F.min("bands").alias("bands")),
        "classes",
    )
    banded = classes.select("rep", "n_shingles", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # The text that many others vary shares more buckets than they do with each other.
    degree = -F.sum("n").over(Window.partitionBy("rep"))  # a text has as many rows as bands
    members = stage_few(
        banded.join(shared, "bucket").select(
            "bucket", "rep", "n_shingles", F.lit(0).cast("long").alias("at"),
            degree.alias("rank"), F.col("rep").alias("label"),
        ),
        "members",
    )
    texts = read.withColumnRenamed("doc_id", "rep").join(members.select("rep").distinct(), "rep")
    texts = stage(texts.select(F.col("rep").alias("doc_id"), "text"), "texts")
    labels = texts.select(F.col("doc_id").alias("rep"), F.col("doc_id").alias("label"))
    tested, leaders_each = None, 1
    while True:
        mixed_up = (
            members.groupBy("bucket")
            .agg(F.min("label").alias("low"), F.max("label").alias("high"))
            .filter("low < high")
        )
        members = stage_few(members.join(mixed_up.select("bucket"), "bucket"), "members")
        if members.isEmpty():
            break
        choice = F.pmod(F.xxhash64("rep"), F.lit(leaders_each)).alias("choice")
        leaders = members.groupBy("bucket", choice).agg(
            F.min(F.struct("rank", "rep", "label", "n_shingles", "at")).alias("first")
        )
        leaders = stage_few(
            leaders.select(
                "bucket",
                F.col("first.rep").alias("leader"),
                F.col("first.label").alias("leader_label"),
                F.col("first.n_shingles").alias("leader_n"),
                F.col("first.at").alias("leader_at"),
            ),
            "leaders",
        )
        places = [F.col(c) for c in ("n_shingles", "at", "leader_n", "leader_at")]
        pairs = members.join(leaders, "bucket").filter("label <> leader_label")
        pairs = pairs.filter(may_be_linked(*places, percent))
        pairs = pairs.select("leader", F.col("rep").alias("member")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["leader", "member"], "left_anti")
        met = stage(compared(pairs, texts, size, percent), "met")
        links = met.filter("linked").select(F.col("leader").alias("u"), F.col("member").alias("v"))
        if not links.isEmpty():
            known = labels.select("rep", "label")
            ends = links.join(known, links["u"] == known["rep"])
            ends = ends.select(F.col("label").alias("u"), "v")
            ends = ends.join(known, ends["v"] == known["rep"])
            moved = stars(ends.select("u", F.col("label").alias("v")))
            moved = moved.withColumnRenamed("node", "label")
            now = F.coalesce("component", "label").alias("label")
            labels = stage_few(labels.join(moved, "label", "left").select("rep", now), "labels")
            members = members.join(moved, "label", "left").select(
                "bucket", "rep", "n_shingles", "at", "rank", now
            )
        done = met.select("leader", "member")
        if tested is None:
            tested = done
            left = (
                members.groupBy("bucket")
                .agg(F.min("label").alias("low"), F.max("label").alias("high"))
                .filter("low < high")
                .select("bucket")
            )
            members = rare_buckets(members.join(left, "bucket"), leaders, texts, size, percent)
        else:
            tested = tested.unionByName(done)
            gone = leaders.select("bucket", F.col("leader").alias("rep"))
            members = members.join(gone, ["bucket", "rep"], "left_anti")
        leaders_each = min(MORE_LEADERS * leaders_each, 1 << 20)
    component = classes.join(labels, "rep", "left").select(
        *same, F.coalesce("label", "rep").alias("component_id")
    )
    return signed.join(component, same, "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNull(), None)
        .otherwise(F.coalesce("component_id", "doc_id"))
        .alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, size: int = 5, **options) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that with the smallest doc_id.

    All columns stay.  Where doc_id is null or repeated, rows are told apart by a
    number of their own, and of a group the first by that number stays.
    """
    columns = docs.columns
    docs, row = row_key(docs)
    groups = near_groups(docs, key=row, size=size, **options)
    kept = groups.filter("kept").select(F.col("doc_id").alias(row))
    return docs.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in columns])
