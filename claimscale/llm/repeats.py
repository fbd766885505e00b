"""Where windows of a fixed length recur in a corpus.

The positions of a text are units (bytes, or words).  Each window of so many units
has an anchor: the smallest hash among its grams, so equal windows have equal
anchors wherever they stand.  Consecutive windows of one anchor are a segment.
Segments of one anchor are the only places where equal windows can stand, so work is
shared out by anchor:

1. a bitmap of bounded size says which anchors may occur twice; others are dropped;
2. equal segments (by anchor and hash of the whole content) form a class;
3. where an anchor has several classes, the contents of one member of each are
   compared, by the operator's own method; an anchor with very many classes is cut
   finer before, by longer grams;
4. what a class knows holds for all its members; the stretches found meet their
   texts again by document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscale.llm.arrow_text import chunks, mixed
from claimscale.session import shuffle_width
from claimscale.sources.staging import discard, fresh_path, stage_and_free

MOST_BITS = 29  # of the bitmap: 64 MB at most, whatever the input
LEAST_BITS = 16
FINER_BITS = 3  # slots are counted up to so much finer than the bitmap
PART_BITS = 24  # slots that one task counts, at most
CHUNK_BYTES = 1 << 17  # of text whose arrays stay in a core's cache
HELD_SLOTS = 1 << 18  # that leave a task at once
MANY_CLASSES = 2_000
SHARD_BYTES = 4 << 20  # of contents that one call of an operator's method gets, on average
BATCH_ROWS, BATCH_BYTES = 10_000, 2 << 20  # of a batch that a task gives back
BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 24) - 1)
_SPAN_BITS = 31  # below a segment's first window, in one number

# Windows of a segment start from ``first`` to ``first`` + ``span``, a small number that packs well.
_SEGMENTS = "anchor long, seg long, doc long, first int, span int"
_CONTENTS = "anchor long, seg long, doc long, members long, content binary"
_PIECES = (
    "anchor long, seg long, doc long, members long, first int, span int, part long, piece long, content binary"
)
_FOUND = "anchor long, seg long, starts array<int>, ends array<int>"

_OTHER = np.uint64(0x2545F4914F6CDD1D)
_ODD = np.uint64(0xD6E8FEB86659FD93)

# Turns bytes and offsets of texts into unit hashes and offsets of units.
Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, modulo 2 ** 64."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        found = np.full(n + 1, base, np.uint64)
        found[0] = 1
        out.append(np.multiply.accumulate(found))
    return tuple(out)


@lru_cache(maxsize=4)
def _places(n: int) -> np.ndarray:
    """What stands below the hashes of n grams: the later the smaller."""
    return _PLACE - (np.arange(n, dtype=np.uint64) & _PLACE)


def _shuffled(h: np.ndarray) -> np.ndarray:
    """One to one, in place: the upper bits follow from all; half the work of ``mixed``."""
    h ^= h >> np.uint64(32)
    h *= _ODD
    return h


def segments(
    units: np.ndarray, offsets: np.ndarray, window: int, gram: int, hashed: bool = True
) -> tuple:
    """All segments: anchor, hash of the content (if ``hashed``), text, first and last window start."""
    n = len(units)
    if n < window:
        return tuple(np.zeros(0, np.uint64) for _ in range(5))
    powers, back = _powers(1 << n.bit_length())
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(units * powers[:n], out=sums[1:])
    grams = sums[gram:] - sums[:-gram]
    grams *= back[: n - gram + 1]
    grams = _shuffled(grams)
    # The place below the hash: of equal grams the rightmost is the anchor, so that a
    # passage that repeats within a text has a segment for each occurrence.
    least = grams & ~_PLACE
    least |= _places(1 << n.bit_length())[: len(grams)]
    width, span = window - gram + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: span - width], least[width - span :])
    # A segment begins where the anchor changes and where a text does; the last
    # positions of a text begin no window.
    head = np.ones(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=head[1:])
    head[offsets[:-1][np.diff(offsets) >= window]] = True
    begin = np.maximum(offsets[:-1], offsets[1:] - window + 1)
    counts = offsets[1:] - begin
    outside = np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    head[outside[outside < len(head)]] = False
    first = np.flatnonzero(head)
    text = np.searchsorted(offsets, first, side="right") - 1
    last = np.minimum(np.append(first[1:], len(least)) - 1, offsets[text + 1] - window)
    content = np.zeros(0, np.uint64)
    if hashed:
        # The content's hash is of other units than the anchor's: both together are 128 bits.
        np.cumsum(_shuffled(units ^ _OTHER) * powers[:n], out=sums[1:])
        content = mixed((sums[last + window] - sums[first]) * back[first])
        content += (last - first).astype(np.uint64)
    place = _PLACE - (least[first] & _PLACE)
    anchor = grams[first + ((place - first.astype(np.uint64)) & _PLACE).astype(np.int64)]
    return anchor, content, text, first - offsets[text], last - offsets[text]


def _slots(anchors: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(anchors ^ np.uint64(0xA5A5A5A5)) >> np.uint64(64 - bits)).astype(np.int64)


def _per_part(bits: int, parts: int, fold: int) -> int:
    """Slots of one part: whole bytes of the bitmap, each bit of it from 2 ** ``fold`` slots."""
    return (8 << fold) * -(-(1 << bits) // ((8 << fold) * parts))


def _send_slots(units: Units, window: int, gram: int, bits: int, parts: int, fold: int):
    per_part = _per_part(bits, parts, fold)

    def sent(held: list[np.ndarray]) -> pa.RecordBatch:
        slots = np.sort(np.concatenate(held))
        cuts = np.searchsorted(slots, np.arange(parts + 1) * per_part)
        rows = []
        for part in np.flatnonzero(np.diff(cuts)):
            own = slots[cuts[part] : cuts[part + 1]] - part * per_part
            steps = np.diff(own, prepend=0).astype("<u4")
            # High bytes of small steps are zero: together they compress well.
            rows.append((part, steps.view(np.uint8).reshape(-1, 4).T.tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
            names=["part", "steps"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for _, data, offsets in chunks(batches, limit=CHUNK_BYTES):
            held.append(_slots(segments(*units(data, offsets), window, gram, hashed=False)[0], bits))
            n += len(held[-1])
            if n >= HELD_SLOTS:
                yield sent(held)
                held, n = [], 0
        if n:
            yield sent(held)

    return run


def _seen_twice(bits: int, parts: int, fold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_part = _per_part(bits, parts, fold)
        once, twice = {}, {}
        for batch in batches:
            for part, blob in zip(*(batch.column(c).to_pylist() for c in ("part", "steps"))):
                if part not in once:
                    once[part], twice[part] = np.zeros(per_part, bool), np.zeros(per_part, bool)
                steps = np.frombuffer(blob, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
                slots = np.cumsum(steps, dtype=np.int64)
                twice[part][slots[once[part][slots]]] = True
                twice[part][slots[1:][steps[1:] == 0]] = True
                once[part][slots] = True
        if twice:
            folded = [t.reshape(-1, 1 << fold).any(axis=1) for t in twice.values()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(twice), pa.int32()),
                    pa.array([np.packbits(t).tobytes() for t in folded], pa.binary()),
                ],
                names=["part", "bits"],
            )

    return run


def recurring_slots(docs: DataFrame, units: Units, window: int, gram: int) -> np.ndarray:
    """A packed bitmap over hashed anchors: those that may occur more than once.

    Its size follows the text up to 2 ** MOST_BITS bits and stays there; a fuller map
    lets more anchors through, and nothing else changes.  Beyond that size anchors are
    still counted in finer slots, so that a bit is set by anchors that recur and seldom
    by two different ones that met in it.
    """
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    wanted = max(int(n_bytes).bit_length(), LEAST_BITS)
    bits = min(wanted, MOST_BITS)
    finer = min(wanted, bits + FINER_BITS)
    fold = finer - bits
    parts = max(min(shuffle_width(docs.sparkSession), 256), 1 << max(finer - PART_BITS, 0))
    found = (
        docs.select("text")
        .mapInArrow(_send_slots(units, window, gram, finer, parts, fold), "part int, steps binary")
        .repartitionById(parts, F.col("part"))
        .mapInArrow(_seen_twice(finer, parts, fold), "part int, bits binary")
    )
    path = fresh_path(docs.sparkSession, "slots")
    found = stage_and_free(found, path)
    per_part = _per_part(finer, parts, fold) >> fold
    packed = np.zeros(per_part * parts // 8, np.uint8)
    for row in found.toLocalIterator():
        at = row["part"] * per_part // 8
        packed[at : at + per_part // 8] = np.frombuffer(row["bits"], np.uint8)
    discard(docs.sparkSession, path)
    return packed[: (1 << bits) // 8]


def _candidates(units: Units, window: int, gram: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = shared.value
        bits = int(len(packed) * 8).bit_length() - 1
        for rows, data, offsets in chunks(batches, limit=CHUNK_BYTES):
            anchor, content, text, first, last = segments(*units(data, offsets), window, gram)
            slot = _slots(anchor.copy(), bits)
            hit = (packed[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1
            doc = rows.column("doc").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor[hit].view(np.int64)),
                    pa.array(content[hit].view(np.int64)),
                    pa.array(doc[text[hit].astype(np.int64)], pa.int64()),
                    pa.array(first[hit].astype(np.int32)),
                    pa.array((last - first)[hit].astype(np.int32)),
                ],
                names=[f.split()[0] for f in _SEGMENTS.split(", ")],
            )

    return run


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        packed = pa.array([pack(t or b"") for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc"), packed], names=["doc", "packed"])


@lru_cache(maxsize=1)
def _unpacker() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def unpack(blob: bytes) -> bytes:
    return _unpacker().decompress(blob) if blob else b""


def packed_texts(docs: DataFrame) -> DataFrame:
    """doc, packed: the whole texts, compressed before they cross the network."""
    return docs.select("doc", "text").mapInArrow(_compressed, "doc long, packed binary")


def rows_of(lists: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Where the rows of lists of numbers begin and end (null: empty), and the fields of all."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    edges = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=edges[1:])
    held = lists.flatten()
    names = [f.name for f in held.type]
    return edges, {n: c.to_numpy(zero_copy_only=False) for n, c in zip(names, held.flatten())}


def _contents(cut: Callable[[bytes, list[tuple[int, int]]], list[bytes]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _CONTENTS.split(", ")]
        for batch in batches:
            edges, wanted = rows_of(batch.column("wanted"))
            wanted["doc"] = np.repeat(batch.column("doc").to_numpy(zero_copy_only=False), np.diff(edges))
            places = list(zip(wanted["first"].tolist(), wanted["last"].tolist()))
            held, begun, n_bytes = [], 0, 0
            for i, packed in enumerate(batch.column("packed")):
                found = cut(unpack(packed.as_py()), places[edges[i] : edges[i + 1]])
                # Many rows to a batch, but only some megabytes.
                for at in range(0, len(found), BATCH_ROWS):
                    some = found[at : at + BATCH_ROWS]
                    held += some
                    n_bytes += sum(map(len, some))
                    if len(held) >= BATCH_ROWS or n_bytes >= BATCH_BYTES:
                        yield _held(wanted, begun, held, names)
                        begun, held, n_bytes = begun + len(held), [], 0
            if held:
                yield _held(wanted, begun, held, names)

    return run


def _held(wanted: dict[str, np.ndarray], begun: int, held: list[bytes], names: list[str]) -> pa.RecordBatch:
    numbers = [pa.array(wanted[n][begun : begun + len(held)], pa.int64()) for n in names[:-1]]
    return pa.RecordBatch.from_arrays([*numbers, pa.array(held, pa.binary())], names=names)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of stretches, as disjoint ones in order; touching ones become one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    if not len(starts):
        return starts, reach
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > reach[:-1]
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def _pieces(units: Units, window: int, gram: int, cut: Callable):
    """The segments of contents by anchors of longer grams, with what they hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, "content", limit=1 << 18):
            anchor, content, text, first, last = segments(*units(data, offsets), window, gram)
            text, first, last = (a.astype(np.int64) for a in (text, first, last))
            edges = np.searchsorted(text, np.arange(rows.num_rows + 1))
            held = []
            for i, whole in enumerate(rows.column("content").to_pylist()):
                own = slice(edges[i], edges[i + 1])
                held += cut(whole, list(zip(first[own].tolist(), last[own].tolist())))
            yield pa.RecordBatch.from_arrays(
                [
                    *(rows.column(c).take(pa.array(text)) for c in ("anchor", "seg", "doc", "members")),
                    pa.array(first.astype(np.int32)),
                    pa.array((last - first).astype(np.int32)),
                    pa.array(anchor.view(np.int64)),
                    pa.array(content.view(np.int64)),
                    pa.array(held, pa.binary()),
                ],
                names=[f.split()[0] for f in _PIECES.split(", ")],
            )

    return run


def _stretches_in(span: Column, whole: Column, window: int) -> Column:
    """What is covered of a segment: all of it, or what was found in its class."""
    window_run = F.struct(F.lit(0).alias("starts"), (span + F.lit(window)).alias("ends"))
    return F.when(whole, F.array(window_run)).otherwise(F.arrays_zip("starts", "ends"))


def _covered(
    contents: DataFrame,
    hot: DataFrame,
    units: Units,
    window: int,
    gram: int,
    cut: Callable,
    resolve: Callable[[pa.Table], pa.Table],
    earlier_only: bool,
    many_classes: int,
    folder: str,
) -> DataFrame:
    """anchor, seg, starts, ends: what is covered of ``contents`` (see ``_CONTENTS``).

    The contents of ``hot`` anchors are cut into segments again, by anchors of grams half
    as far from the window's length: a few for each content, and equal windows meet again.
    Segments equal to another become one class, those whose anchor stands alone go, and
    the rest is work of the same kind.  A gram of the window's length is the window, and its
    anchor has one class; so this ends, after a logarithm of the length's steps at most.
    """
    usual = contents.join(hot, "anchor", "left_anti")
    found = (
        usual.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shard_count(usual))))
        .groupBy("shard")
        .applyInArrow(lambda table: resolve(table), _FOUND)
    )
    if gram >= window or hot.isEmpty():
        return found
    gram = (gram + window + 1) // 2
    pieces = contents.join(hot, "anchor", "left_semi").mapInArrow(_pieces(units, window, gram, cut), _PIECES)
    pieces = stage_and_free(pieces, f"{folder}/pieces-{gram}")
    key = ["part", "piece"]
    classes = pieces.groupBy(*key).agg(
        F.sum("members").alias("members"), F.min("doc").alias("earliest"), F.min("content").alias("content")
    )
    # Numbers only, and no window over them: of one anchor there may be very many.
    counts = pieces.select(*key, "members").groupBy(*key).agg(F.sum("members").alias("n"))
    counts = counts.groupBy("part").agg(F.count(F.lit(1)).alias("n_classes"), F.sum("n").alias("n"))
    classes = classes.join(counts.filter("n > 1").drop("n"), "part").withColumn(
        "content", F.when(F.col("n_classes") > 1, F.col("content"))
    )
    classes = stage_and_free(classes, f"{folder}/classes-{gram}")
    finer = _covered(
        classes.filter("n_classes > 1").select(
            F.col("part").alias("anchor"), F.col("piece").alias("seg"), F.col("earliest").alias("doc"),
            "members", "content",
        ),
        classes.filter(F.col("n_classes") > many_classes).select(F.col("part").alias("anchor")).distinct(),
        units, window, gram, cut, resolve, earlier_only, many_classes, folder,
    )
    finer = finer.select(F.col("anchor").alias("part"), F.col("seg").alias("piece"), "starts", "ends")
    outcome = classes.select(*key, "earliest", F.col("members").alias("n")).join(finer, key, "left")
    whole = F.col("doc") > F.col("earliest") if earlier_only else F.col("n") > 1
    covered = pieces.drop("content", "members").join(outcome.filter("n > 1 or starts is not null"), key)
    covered = covered.withColumn("own", _stretches_in(F.col("span"), whole, window)).filter("size(own) > 0")
    at = F.flatten(F.collect_list(F.transform("own", lambda s: F.struct(
        (F.col("first") + s["starts"]).alias("starts"), (F.col("first") + s["ends"]).alias("ends")
    ))))
    covered = covered.groupBy("anchor", "seg").agg(at.alias("own"))
    return found.unionByName(
        covered.select("anchor", "seg", F.col("own.starts").alias("starts"), F.col("own.ends").alias("ends"))
    )


def shard_count(contents: DataFrame) -> int:
    """How many groups of anchors keep each at some SHARD_BYTES, whatever the session's width."""
    n_bytes = contents.agg(F.sum(F.octet_length("content") + 32)).first()[0] or 0
    return max(4 * shuffle_width(contents.sparkSession), -(-n_bytes // SHARD_BYTES))


def stretches(
    docs: DataFrame,
    units: Units,
    window: int,
    gram: int,
    cut: Callable,
    windows: Callable,
    resolve: Callable[[pa.Table], pa.Table],
    earlier_only: bool,
    many_classes: int = MANY_CLASSES,
    folder: str | None = None,
) -> DataFrame:
    """Stretches of units covered by windows that recur: doc, start, end (long, exclusive).

    ``docs`` has doc (a long, unique) and text.  With ``earlier_only`` a window
    counts when it also stands in a document of smaller number, else when it stands
    anywhere else, its own document included.  ``resolve`` gets the contents of some
    anchors' classes (SHARD_BYTES on average, and never less than one anchor) and finds the covered stretches of each by the operator's method.
    Anchors with more than ``many_classes`` classes are not gathered: their contents are
    cut finer first (see ``_covered``); ``windows`` is not needed for that and not called.  Overlapping stretches are not yet merged.  The stretches are
    not worked out yet; they read tables in ``folder`` (see ``written_stretches``).
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "stretches")
    shared = spark.sparkContext.broadcast(recurring_slots(docs, units, window, gram))
    found = stage_and_free(
        docs.select("doc", "text").mapInArrow(_candidates(units, window, gram, shared), _SEGMENTS),
        f"{folder}/segments",
    )
    key = ["anchor", "seg"]
    # Numbers only, so Spark combines in a hash table; of a class's members in its least
    # document any one may stand for it.
    place = F.shiftleft(F.col("first").cast("long"), _SPAN_BITS).bitwiseOR(F.col("span").cast("long"))
    classes = found.groupBy(*key).agg(
        F.count(F.lit(1)).alias("members"), F.min("doc").alias("earliest"), F.min_by(place, "doc").alias("place")
    )
    # Classes cross the network once: a window counts those of an anchor beside them.
    of_anchor = Window.partitionBy("anchor")
    classes = classes.withColumns(
        {"n_classes": F.count(F.lit(1)).over(of_anchor), "n": F.sum("members").over(of_anchor)}
    )
    classes = stage_and_free(classes.filter("n > 1").drop("n"), f"{folder}/classes")
    first = F.shiftright("place", _SPAN_BITS)
    span = F.col("place").bitwiseAND(F.lit((1 << _SPAN_BITS) - 1))
    wanted = classes.filter("n_classes > 1").groupBy(F.col("earliest").alias("doc")).agg(
        F.collect_list(
            F.struct("anchor", "seg", "members", first.alias("first"), (first + span).alias("last"))
        ).alias("wanted")
    )
    contents = packed_texts(docs).join(wanted, "doc").mapInArrow(_contents(cut), _CONTENTS)
    contents = stage_and_free(contents, f"{folder}/contents")
    # At most one anchor for every so many classes.
    hot = classes.filter(F.col("n_classes") > many_classes).select("anchor").distinct()
    covered = _covered(
        contents, hot, units, window, gram, cut, resolve, earlier_only, many_classes, f"{folder}/finer"
    )
    covered = stage_and_free(covered, f"{folder}/covered")
    for done in ("contents", "finer"):
        discard(spark, f"{folder}/{done}")
    whole = F.col("doc") > F.col("earliest") if earlier_only else F.col("members") > 1
    outcome = classes.drop("place", "n_classes").join(covered, key, "left")
    placed = found.select(*key, "doc", place.alias("place"))
    met = placed.join(outcome.filter("members > 1 or starts is not null"), key)
    met = met.withColumns({"first": first.cast("int"), "span": span.cast("int")})
    # Both kinds in one select: two would read and shuffle all segments twice.
    own = _stretches_in(F.col("span"), whole, window)
    return met.select("doc", "first", F.explode(own).alias("s")).select(
        "doc",
        (F.col("first") + F.col("s.starts")).alias("start"),
        (F.col("first") + F.col("s.ends")).alias("end"),
    )


def written_stretches(docs: DataFrame, *args, **options) -> DataFrame:
    """``stretches`` as a table; the tables that led there are gone when the texts meet it."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "stretches")
    found = stretches(docs, *args, folder=folder, **options)
    spans = stage_and_free(found, fresh_path(spark, "spans"))
    discard(spark, folder)
    return spans
