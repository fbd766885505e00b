"""Phrase collocations by stripes: each prefix keys an associative counter of next words.

A task counts, for every prefix of its texts, the words that follow; such stripes are
merged elementwise.  The count under (prefix, word) is the phrase's own, the total of
the stripe one word longer, and by its greatest value also tells which shorter phrases
it stands for.  Stripes grow a word at a time, from the empty prefix on: a phrase that
is frequent enough has only such parts, so a longer window is counted only where both
of its shorter ones are frequent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscale.llm.arrow_text import chunks, mixed, word_hashes, words
from claimscale.llm.spans import buffers, gather, numbered, strings
from claimscale.operators.joins import lookup_join
from claimscale.operators.ranking import top_per_key
from claimscale.session import shuffle_width
from claimscale.sources.staging import stage

LONGEST = 4
LEAST = 30
SHARE = 80  # percent of its occurrences that a longer phrase must have to stand for a shorter
TOP = 2000
UNKNOWN = "und"
CHUNK_BYTES = 3 << 20  # of text counted at once; the arrays in use are some 40 times that
PART_BYTES = 2 << 20
HEAVY_SHARE = 0.002  # of all words; at most 500 prefixes are that common
MERGE_ROWS = 1 << 20
MOST_BITS, SPARE_BITS = 29, 5

_BREAK, _BLANK = 0x0A, 0x20
_SIGNS = np.arange(256, dtype=np.uint8)
_SIGNS[ord("A") : ord("Z") + 1] += 32
_SIGNS[[ord(c) for c in ".,;:!?"]] = _BREAK
_SIGNS[0x0A:0x0E] = _BREAK

_STRIPES = "lang string, prefix binary, shard int, followers binary, counts array<int>"
_PHRASES = "lang string, words int, phrase binary, f long"


class _Words:
    """The words of some texts: a number per word, its piece and its language."""

    def __init__(self, rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> None:
        data = _SIGNS[data]
        starts, ends, first = words(data, offsets)
        self.n = len(starts)
        coded = rows.column("lang").dictionary_encode()
        self.langs = coded.dictionary
        lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        breaks = np.zeros(len(data) + 1, np.int32)
        np.cumsum(data == _BREAK, out=breaks[1:])
        new = np.ones(self.n, bool)
        new[1:] = (text[1:] != text[:-1]) | (breaks[starts[1:]] > breaks[ends[:-1]])
        self.piece = np.cumsum(new)
        self.lang = lang[text]
        self.number, contents = numbered(data, starts, ends - starts)
        held, at = buffers(contents)
        # Each content once, and a blank after it.
        sizes = np.diff(at)
        ended = np.insert(held, at[1:], _BLANK)
        self.ended, self.sizes = ended, sizes + 1
        self.at = np.cumsum(self.sizes) - self.sizes
        self.hash = word_hashes(held, at[:-1], at[1:])
        lang_bytes, lang_at = buffers(self.langs)
        self.lang_hash = word_hashes(lang_bytes, lang_at[:-1], lang_at[1:], seed=1)

    def windows(self, size: int) -> np.ndarray:
        """Places where ``size`` words of one piece start."""
        last = max(self.n - size + 1, 0)
        return np.flatnonzero(self.piece[:last] == self.piece[size - 1 : size - 1 + last])

    def hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        """A hash of the language and the ``size`` words from each place on."""
        found = self.lang_hash[self.lang[at]]
        for i in range(size):
            found = mixed(found + self.hash[self.number[at + i]])
        return found

    def texts(self, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of ``size`` words from each place on, each with a blank, and their lengths."""
        which = self.number[at[:, None] + np.arange(size)]
        sizes = self.sizes[which]
        return gather(self.ended, self.at[which].ravel(), sizes.ravel()), sizes.sum(1)


def _binary(held: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(held))]
    )


def _is_set(packed: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (packed[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _stripes(length: int, frequent, heavy: np.ndarray, cuts: np.ndarray):
    """Stripes of all prefixes of ``length`` words, one row each.

    ``frequent`` is a broadcast bitmap of phrases of that length; both the prefix and
    the last words of a window have to be in it.  A prefix whose hash is in ``heavy``
    falls into as many shards as ``cuts`` says, by the hash of the next word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, limit=CHUNK_BYTES):
            held = _Words(rows, data, offsets)
            at = held.windows(length + 1)
            if length:
                packed = frequent.value
                bits = int(len(packed) * 8).bit_length() - 1
                both = _is_set(packed, _slots(held.hashes(at, length), bits))
                at = at[both]
                at = at[_is_set(packed, _slots(held.hashes(at + 1, length), bits))]
            if not len(at):
                continue
            v = len(held.sizes)
            prefix = held.lang[at]
            for i in range(length):
                prefix = prefix * v + held.number[at + i]
                if i:  # keep the numbers small
                    prefix = np.unique(prefix, return_inverse=True)[1]
            key, pick, counts = np.unique(
                prefix * v + held.number[at + length], return_index=True, return_counts=True
            )
            at, prefix = at[pick], key // v
            shard = np.zeros(len(at), np.int64)
            if len(heavy):
                mine = held.hashes(at, length)
                place = np.minimum(np.searchsorted(heavy, mine), len(heavy) - 1)
                shards = np.where(heavy[place] == mine, cuts[place], 1).astype(np.uint64)
                shard = (mixed(held.hash[held.number[at + length]]) % shards).astype(np.int64)
                order = np.lexsort((shard, prefix))
                at, prefix, shard, counts = (x[order] for x in (at, prefix, shard, counts))
            new = np.ones(len(at), bool)
            new[1:] = (prefix[1:] != prefix[:-1]) | (shard[1:] != shard[:-1])
            first = np.flatnonzero(new)
            border = np.append(first, len(at))
            followers, sizes = held.texts(at + length, 1)
            lists = pa.ListArray.from_arrays(pa.array(border, pa.int32()), pa.array(counts, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    held.langs.take(pa.array(held.lang[at[first]])),
                    _binary(*held.texts(at[first], length)),
                    pa.array(shard[first], pa.int32()),
                    _binary(followers, np.add.reduceat(sizes, first)),
                    lists,
                ],
                names=[f.split()[0] for f in _STRIPES.split(", ")],
            )
            del held, followers, lists
            pa.default_memory_pool().release_unused()

    return run


def _opened(batch: pa.RecordBatch) -> pa.Table:
    """The stripes' counters, one row per prefix and next word."""
    data, _ = buffers_of(batch.column("followers"))
    ends = np.flatnonzero(data == _BLANK)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
    sizes = batch.column("counts").value_lengths().to_numpy(zero_copy_only=False)
    row = pa.array(np.repeat(np.arange(len(sizes)), sizes))
    return pa.table(
        {
            "lang": batch.column("lang").take(row),
            "prefix": batch.column("prefix").take(row),
            "word": strings(data, starts, ends - starts).cast(pa.binary()),
            "f": batch.column("counts").flatten().cast(pa.int64()),
        }
    )


def buffers_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that the rows of a binary column hold, and their offsets from 0."""
    data, at = buffers(column)
    return data[at[0] : at[-1]], at - at[0]


def _merge(tables: list[pa.Table]) -> pa.Table:
    keys = ["lang", "prefix", "word"]
    found = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([("f", "sum")])
    return found.rename_columns({"f_sum": "f"})


def _merged(length: int, least: int):
    """Stripes merged elementwise: phrases that occur ``least`` times at least.

    Of the empty prefix also each language's total, as phrase of no words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, open_, waiting = None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            open_.append(_opened(batch))
            waiting += open_[-1].num_rows
            if waiting >= max(MERGE_ROWS, held.num_rows if held else 0):
                held, open_, waiting = _merge([held, *open_] if held else open_), [], 0
                pa.default_memory_pool().release_unused()
        if open_:
            held = _merge([held, *open_] if held else open_)
        if held is None:
            return
        names = [f.split()[0] for f in _PHRASES.split(", ")]
        if not length:
            totals = held.group_by("lang", use_threads=False).aggregate([("f", "sum")])
            none = pa.array([0] * totals.num_rows, pa.int32())
            empty = pa.array([b""] * totals.num_rows, pa.binary())
            columns = [totals["lang"].combine_chunks(), none, empty, totals["f_sum"].combine_chunks()]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        found = held.filter(pa.compute.greater_equal(held["f"], least)).combine_chunks()
        for part in found.to_batches(max_chunksize=100_000):
            n = part.num_rows
            joined = pa.compute.binary_join_element_wise(
                part["prefix"], part["word"], pa.scalar(b" ", pa.binary()), pa.scalar(b"", pa.binary())
            )
            columns = [part["lang"], pa.array([length + 1] * n, pa.int32()), joined, part["f"]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _phrase_hashes(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """As ``_Words.hashes`` of phrases that are written out, each word with a blank."""
    data, _ = buffers_of(batch.column("phrase"))
    ends = np.flatnonzero(data == _BLANK)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
    hashes = word_hashes(data, starts, ends).reshape(-1, size)
    langs, at = buffers_of(batch.column("lang"))
    found = word_hashes(langs, at[:-1], at[1:], seed=1)
    for i in range(size):
        found = mixed(found + hashes[:, i])
    return found


def _send_slots(size: int, bits: int, parts: int):
    per_part = (1 << bits) // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = np.unique(_slots(_phrase_hashes(batch, size), bits))
            part = slots // per_part
            for one in np.unique(part):
                blob = (slots[part == one] % per_part).astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([one], pa.int32()), pa.array([blob], pa.binary())],
                    names=["part", "bits"],
                )

    return run


def _pack_slots(bits: int, parts: int):
    per_part = (1 << bits) // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(*(batch.column(c).to_pylist() for c in ("part", "bits"))):
                held = maps.setdefault(part, np.zeros(per_part, bool))
                held[np.frombuffer(blob, "<u4")] = True
        if maps:
            packed = [np.packbits(m).tobytes() for m in maps.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(maps), pa.int32()), pa.array(packed, pa.binary())],
                names=["part", "bits"],
            )

    return run


def _bitmap(phrases: DataFrame, size: int, count: int) -> np.ndarray:
    """Packed bits of the hashes of phrases; 64 MB at most, and a fuller map lets more through."""
    bits = min(max(count.bit_length() + SPARE_BITS, 16), MOST_BITS)
    parts = 1 << max(bits - 20, 0)
    found = (
        phrases.mapInArrow(_send_slots(size, bits, parts), "part int, bits binary")
        .repartitionById(min(parts, shuffle_width(phrases.sparkSession)), F.col("part"))
        .mapInArrow(_pack_slots(bits, parts), "part int, bits binary")
    )
    packed = np.zeros((1 << bits) // 8, np.uint8)
    per_part = len(packed) // parts
    for row in found.toLocalIterator():
        packed[row["part"] * per_part : (row["part"] + 1) * per_part] = np.frombuffer(row["bits"], np.uint8)
    return packed


def _heavy(phrases: DataFrame, size: int, all_words: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the prefixes that hold a large share of all words, and their shards."""
    common = phrases.filter(F.col("f") > HEAVY_SHARE * all_words)
    rows = common.select("lang", "phrase", "f").toArrow().combine_chunks()
    if not rows.num_rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    batch = rows.to_batches()[0]
    hashes = _phrase_hashes(batch, size)
    share = batch.column("f").to_numpy(zero_copy_only=False) / all_words
    cuts = np.clip(np.ceil(4 * share * width), 2, max(width, 2)).astype(np.int64)
    order = np.argsort(hashes)
    return hashes[order], cuts[order]


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """lang, words, phrase, f: all phrases of 1 to ``longest`` words that occur often enough.

    Each word of a phrase has a blank after it.  The phrase of no words is the number of
    all words of a language.  Texts are read once per length; of a prefix with a large
    share of all words (known from the length before) the stripe is spread by its next
    words, so no task gets more of it than of others.
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    texts = docs.select(lang, "text")
    n_bytes = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    width = shuffle_width(spark)
    n = int(max(1, min(width, n_bytes // PART_BYTES), n_bytes // (4 * PART_BYTES)))
    levels, all_words, frequent = [], 0, None
    for length in range(longest):
        if not length:
            # All stripes of the empty prefix; a stripe's hash is its language's.
            langs = texts.select("lang").distinct().toArrow().combine_chunks()
            known = langs.to_batches()[0] if langs.num_rows else None
            heavy = np.sort(_lang_hashes(known)) if known else np.zeros(0, np.uint64)
            cuts = np.full(len(heavy), max(n, 2), np.int64)
        else:
            count = levels[-1].filter(F.col("words") == length)
            size = count.count()
            if not size:
                break
            frequent = spark.sparkContext.broadcast(_bitmap(count, length, size))
            heavy, cuts = _heavy(count, length, all_words, n)
        merged = (
            texts.mapInArrow(_stripes(length, frequent, heavy, cuts), _STRIPES)
            .repartition(n, "lang", "prefix", "shard")
            .mapInArrow(_merged(length, least), _PHRASES)
        )
        if not length:
            none = F.col("words") == 0
            merged = stage(merged, "phrases")
            totals = merged.filter(none).groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
            merged = merged.filter(~none).unionByName(totals)
        levels.append(stage(merged, "phrases"))
        if not length:
            all_words = levels[0].filter(none).agg(F.sum("f")).first()[0] or 0
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found.withColumn("phrase", F.col("phrase").cast("string"))


def _lang_hashes(batch: pa.RecordBatch) -> np.ndarray:
    langs, at = buffers_of(batch.column("lang"))
    return word_hashes(langs, at[:-1], at[1:], seed=1)


def scored_cuts(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score: each candidate at its lowest-scoring cut."""
    listed = F.split(F.rtrim("phrase"), " ")
    candidates = phrases.filter(F.col("words") >= 2).select(
        "lang", "phrase", F.col("f").alias("a"), "words", listed.alias("w")
    )
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "a", "words", "w", cut)
    blank = F.lit(" ")
    sides = cuts.select(
        "lang", "phrase", "a", "k",
        F.concat(F.array_join(F.slice("w", F.lit(1), F.col("k")), " "), blank).alias("left"),
        F.concat(F.array_join(F.slice("w", F.col("k") + 1, F.col("words")), " "), blank).alias("right"),
    )
    counts = phrases.filter(F.col("words") >= 1)
    for side, name in (("left", "l"), ("right", "r")):
        known = counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        sides = lookup_join(sides, known, ["lang", side])
    # Decimals of 38 digits hold the products of any counts.
    score = F.expr("CAST(CAST(a AS DECIMAL(19, 0)) * 2000000 DIV (CAST(l AS DECIMAL(19, 0)) + r) AS BIGINT)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low")
    found = sides.groupBy("lang", "phrase", "a").agg(lowest)
    return found.select("lang", "phrase", "a", "low.l", "low.r", "low.score")


def without_subsumed(candidates: DataFrame, phrases: DataFrame, share: int = SHARE) -> DataFrame:
    """Candidates that no longer phrase stands for.

    It is enough to look at phrases that are longer by one word: those in between are
    at least as frequent as longer ones.
    """
    longer = phrases.filter(F.col("words") >= 3)
    word = F.split(F.rtrim("phrase"), " ")
    parts = F.array(
        F.slice(word, F.lit(1), F.col("words") - 1), F.slice(word, F.lit(2), F.col("words") - 1)
    )
    part = F.concat(F.array_join("part", " "), F.lit(" "))
    most = (
        longer.select("lang", "f", F.explode(parts).alias("part"))
        .groupBy("lang", part.alias("phrase"))
        .agg(F.max("f").alias("most"))
    )
    joined = candidates.join(most, ["lang", "phrase"], "left")
    stands = F.expr(f"CAST(most AS DECIMAL(19, 0)) * 100 >= CAST(a AS DECIMAL(19, 0)) * {int(share)}")
    return joined.filter(F.col("most").isNull() | ~stands).drop("most")


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    share: int = SHARE,
    top: int = TOP,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language.

    Reads ``docs`` (text, lang).  Letters A to Z count as small ones; a text is cut into
    pieces at ``.,;:!?`` and line ends, and those into words at blanks and tabs.  Phrases
    of 2 to ``longest`` words that occur ``least`` times within pieces are scored by
    2,000,000 a / (l + r) at their lowest-scoring cut, rounded down; those that a longer
    one stands for, by ``share`` percent, go.  Ties fall to the more frequent phrase, then
    by its bytes.

    A null or empty text has no words, a null language is ``und``; repeated rows count
    each; an empty table, or one without frequent phrases, gives no rows; other columns
    are not read, whatever their names.  Whole texts are counted, some megabytes (or one
    text) at a time.
    """
    phrases = stage(frequent_phrases(docs, longest, least), "all-phrases")
    kept = without_subsumed(scored_cuts(phrases), phrases, share)
    totals = phrases.filter(F.col("words") == 0).select("lang", F.col("f").alias("n"))
    rows = lookup_join(kept.withColumn("phrase", F.rtrim("phrase")), totals, ["lang"])
    ranked = top_per_key(rows, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    names = ["lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"]
    return ranked.select(*names)
