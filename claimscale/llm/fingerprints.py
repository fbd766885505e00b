"""Document fingerprints by winnowing.

All grams of 8 bytes are hashed; of every 8 consecutive grams the one with the
smallest hash is kept, the rightmost where hashes are equal, with its position.
Any passage of 15 bytes that two texts share therefore leaves one hash in both,
and the positions say where it stands.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscale.llm.arrow_text import mixed
from claimscale.session import shuffle_width

GRAM = 8  # bytes, one word of the machine
WINDOW = 8

_PAIRS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)
_SINGLE = "doc_id long, n_chars long, hashes array<long>, positions array<long>"


def winnow(text: bytes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The kept hashes (32 bits) and their byte positions, in order.

    A text shorter than a gram is one gram; one with fewer grams than a window is
    one window; an empty text keeps nothing.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    padded = text + bytes(GRAM)
    grams = max(n - GRAM + 1, 1)
    words = np.ndarray((grams,), np.dtype("<u8"), padded, 0, (1,))
    size = mixed(np.full(1, min(n, GRAM), np.uint64))
    h = mixed(words * np.uint64(0x9E3779B97F4A7C15) ^ size)
    # Equal hashes: the larger position makes the smaller number.
    place = np.uint64(0xFFFFFFFF) - np.arange(grams, dtype=np.uint64)
    least = (h & np.uint64(0xFFFFFFFF00000000)) | place
    window, span = min(window, grams), 1
    while 2 * span <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < window:
        least = np.minimum(least[: span - window], least[window - span :])
    kept = np.ones(len(least), bool)
    kept[1:] = least[1:] != least[:-1]
    least = least[kept]
    positions = np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))
    return (least >> np.uint64(32)).astype(np.uint32), positions.astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common hashes among all distinct ones; two empty fingerprints are alike."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(both) - common)


def printed(hashes: np.ndarray, positions: np.ndarray) -> str:
    """Base64 of (hash, position) pairs of little-endian unsigned 32-bit numbers."""
    return base64.b64encode(np.stack([hashes, positions], 1).astype("<u4").tobytes()).decode()


def fingerprints(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_chars (code points), hashes and positions of each whole text.

    Null texts are empty: no hashes.  Every row is fingerprinted by itself, so
    repeated rows, null keys and empty tables need no rule; other columns are not
    read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "") for t in batch.column("text").to_pylist()]
            found = [winnow(t.encode(), window) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([f[0].astype(np.int64) for f in found], pa.list_(pa.int64())),
                    pa.array([f[1].astype(np.int64) for f in found], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_chars", "hashes", "positions"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, _SINGLE
    )


def in_neighbourhoods(docs: DataFrame) -> DataFrame:
    """Rows part, is_tail, doc_id, text in the order of doc_id, each part with its successor.

    Parts are ranges of doc_id between keys that occur; the first row of a part
    comes once more at the end of the part before, as its tail, and the very first
    row as the tail of the last part.  So every row stands next to its successor
    without one text more than that crossing the network.  Nulls come first; rows
    that repeat a key are ordered by text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = shuffle_width(docs.sparkSession)
    shares = [i / n for i in range(1, n)] or [0.5]
    borders, first, nulls = docs.agg(
        F.percentile_approx("doc_id", shares, 100 * n),
        F.min("doc_id"),
        F.count_if(F.col("doc_id").isNull()),
    ).first()
    borders = sorted({b for b in borders or [] if b > first}) if n > 1 else []
    if borders:
        listed = F.array(*(F.lit(b) for b in borders))
        part = F.size(F.filter(listed, lambda b: b <= F.col("doc_id")))
        is_border = F.array_contains(listed, F.col("doc_id"))
    else:
        part, is_border = F.lit(0), F.lit(False)
    is_first = F.col("doc_id").isNull() if nulls else F.col("doc_id") == F.lit(first)
    here = F.struct(part.alias("part"), F.lit(False).alias("is_tail"))
    tail = F.struct((part - 1).alias("part"), F.lit(True).alias("is_tail"))
    last = F.struct(F.lit(len(borders)).alias("part"), F.lit(True).alias("is_tail"))
    places = F.array(here, F.when(is_border, tail), F.when(is_first, last))
    return (
        docs.select(F.explode(F.array_compact(places)).alias("place"), "doc_id", "text")
        .select("place.part", "place.is_tail", "doc_id", "text")
        .repartitionById(len(borders) + 1, F.col("part"))
        .sortWithinPartitions("part", "is_tail", "doc_id", "text")
    )


def _edited(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _PAIRS.split(", ")]
        held = None  # the row whose successor comes next
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("part", "is_tail", "doc_id", "text"))
            for part, is_tail, doc_id, text in zip(*columns):
                text = text or ""
                own = None
                if held is not None and held[0] == part:
                    own = winnow(text.encode(), window)
                    out.append(compare(*held[1:], text, own, window))
                if is_tail:
                    held = None
                else:
                    own = own if own is not None else winnow(text.encode(), window)
                    held = (part, doc_id, text, own)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column) for column in zip(*out)], names=names
                )

    return run


def compare(doc_id, text, own, following, its, window: int) -> tuple:
    """One row of the comparison of a text with its edited form and its successor."""
    half = len(text) // 2
    edited = (text[: len(text) - half] + following[:half]).encode()
    changed = winnow(edited, window)
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited).hexdigest(),
        printed(*own),
        printed(*changed),
        likeness(own[0], changed[0]),
        likeness(own[0], its[0]),
    )


def edited_likeness(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """How fingerprints answer to an edit: each text against a half-replaced form of it.

    The edited text has its last floor(n / 2) code points replaced by the first as
    many (or all) of the next document in ascending doc_id, after the last: the
    first.  Returns one row per row of ``docs``: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next (likeness to the edited
    text's and to the next document's fingerprint).

    Null texts are empty; null keys come first; of rows that repeat a key the next
    in the order of texts follows; a single row follows itself; an empty table
    gives no rows.  Other columns are not read.
    """
    return in_neighbourhoods(docs).mapInArrow(_edited(window), _PAIRS)
