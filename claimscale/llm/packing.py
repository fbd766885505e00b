"""Packing documents into sequences along a space-filling curve.

A document is a vector of hashed token counts, projected to three dimensions; its
place on the Hilbert curve through them is the key by which the corpus is
range-partitioned and sorted.  Along the curve, neighbours follow each other into
the sequences, cut wherever a sequence is full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscale.llm.arrow_text import chunks, mixed
from claimscale.llm.token_files import END_ID, with_end
from claimscale.llm.tokens import encoder
from claimscale.session import shuffle_width

SEQUENCE = 1024
DIMENSIONS = 3
BITS = 16
FEATURES = 1 << 16
SPREAD = 0.08  # standard deviations of mean projections seen on prose; the scale only
BORDER_SAMPLE = 64
PART_BYTES = 2 << 20
CHUNK_BYTES = 512 << 10  # of text keyed at once: its ids, features and sums stand beside the encoder's arrays
SEED = 11

_KEYED = "part int, key long, doc_id long, n_tokens long, ids binary"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long"
)


def projection(seed: int = SEED) -> np.ndarray:
    """Random signs per hashed feature and dimension, as an array of floats."""
    features = np.arange(FEATURES * DIMENSIONS, dtype=np.uint64) + np.uint64(seed << 32)
    signs = (mixed(features) >> np.uint64(40)) & np.uint64(1)
    return (signs.astype(np.float32) * 2 - 1).reshape(DIMENSIONS, FEATURES)


def coordinates(ids: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whole numbers of BITS bits: the projected mean vectors, through a logistic curve."""
    features = (mixed(ids.astype(np.uint64)) >> np.uint64(48)).astype(np.int64)
    counts = np.maximum(np.diff(bounds), 1)
    out = np.empty((DIMENSIONS, len(counts)), np.uint64)
    for d in range(DIMENSIONS):
        sums = np.concatenate([[0.0], np.cumsum(table[d][features], dtype=np.float64)])
        mean = (sums[bounds[1:]] - sums[bounds[:-1]]) / counts
        share = 1 / (1 + np.exp(-mean / SPREAD))
        out[d] = np.minimum(share * (1 << BITS), (1 << BITS) - 1).astype(np.uint64)
    return out


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve through a grid; one column per point.

    The axes are turned into the curve's own by undoing, from the highest bit
    down, the reflections and swaps of each sub-cube, then Gray coding; the bits
    of all axes interleaved are the place.
    """
    x = points.astype(np.uint64).copy()
    n, one = len(x), np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        q = np.uint64(1 << bit)
        low = q - one
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        q = np.uint64(1 << bit)
        turn ^= np.where((x[n - 1] & q) != 0, q - one, np.uint64(0))
    x ^= turn
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << one) | ((x[i] >> np.uint64(bit)) & one)
    return place


def _keys(path: str, end_id: int, borders: list[int] | None):
    """Rows of _KEYED; without ``borders`` only their keys, the rest empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, table = encoder(path).encode, projection()
        for rows, data, offsets in chunks(batches, limit=CHUNK_BYTES):
            ids, bounds = encode(data, offsets)
            place = hilbert(coordinates(ids, bounds, table))
            # Below the place, a hash of the document tells copies of one text apart.
            known = rows.column("tie").to_numpy().view(np.uint64)
            key = ((place << np.uint64(15)) | (known >> np.uint64(49))).astype(np.int64)
            n = len(key)
            if borders is None:
                ids, bounds, part = ids[:0], np.zeros(n + 1, np.int64), np.zeros(n)
            else:
                ids, bounds = with_end(ids, bounds, end_id)
                part = np.searchsorted(np.array(borders, np.int64), key, "right")
            small = ids.astype("<u2") if not len(ids) or ids.max() < 1 << 16 else ids.astype("<u4")
            blob = small.tobytes()
            width = small.dtype.itemsize
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.int32()),
                    pa.array(key, pa.int64()),
                    rows.column("doc_id"),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(
                        [blob[width * a : width * b] for a, b in zip(bounds, bounds[1:])],
                        pa.binary(),
                    ),
                ],
                names=[f.split()[0] for f in _KEYED.split(", ")],
            )

    return run


def _pack(length: int):
    """Cut the documents of a range, in its order, into sequences of ``length``.

    Sequences are numbered within their range, whose number is above bit 40.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_no, at = -1, 0
        for batch in batches:
            out = {f.split()[0]: [] for f in _PIECES.split(", ")}
            columns = (batch.column(c).to_pylist() for c in ("part", "doc_id", "n_tokens", "ids"))
            for part, doc_id, n, blob in zip(*columns):
                if part != range_no:
                    range_no, at = part, 0
                ids = np.frombuffer(blob, "<u2" if len(blob) == 2 * n else "<u4").astype("<u4")
                start = 0
                while start < n:
                    size = min(n - start, length - at % length)
                    out["doc_id"].append(doc_id)
                    out["start"].append(start)
                    out["length"].append(size)
                    out["ids_crc32"].append(zlib.crc32(ids[start : start + size].tobytes()))
                    out["doc_tokens"].append(n)
                    out["sequence_id"].append((range_no << 40) + at // length)
                    out["offset"].append(at % length)
                    start, at = start + size, at + size
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int64()) for v in out.values()], names=list(out)
            )

    return run


def _along_curve(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Documents with ids, in ranges of the curve, sorted."""
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.xxhash64("doc_id", "text").alias("tie"),
    )
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    width = shuffle_width(docs.sparkSession)
    n = max(1, min(width, n_bytes // PART_BYTES), n_bytes // (64 * PART_BYTES))
    borders: list[int] = []
    if n > 1:
        # Any borders give a right packing; a hashed sample gives even ranges.
        sample = docs.filter(F.pmod("tie", F.lit(BORDER_SAMPLE)) == 0)
        keys = sample.mapInArrow(_keys(path, end_id, None), _KEYED)
        shares = [i / n for i in range(1, n)]
        borders = keys.agg(F.percentile_approx("key", shares, 100 * n)).first()[0] or []
    keyed = docs.mapInArrow(_keys(path, end_id, sorted(set(borders))), _KEYED)
    return keyed.repartitionById(n, F.col("part")).sortWithinPartitions("part", "key", "doc_id")


def pack(
    docs: DataFrame, tokenizer_path: str, length: int = SEQUENCE, end_id: int = END_ID
) -> DataFrame:
    """Pack all texts of ``docs`` (doc_id, text) into sequences of at most ``length`` ids.

    Returns one row per piece of a document: doc_id, start (its document's ids
    before it), length, ids_crc32 (of its ids as little-endian unsigned 32-bit),
    doc_tokens (with the end id), sequence_id, offset (place in the sequence).
    Every id lies in one piece; sequences have no gaps, and all are full but the
    last of each range.

    A null or empty text is its end id.  Rows that repeat a document are packed
    each.  An empty table gives no rows; other columns are not read.  Copies of
    one text share their place on the curve and are told apart by a hash below
    it, so a text that a third of all rows hold spreads over ranges as well.
    """
    return _along_curve(docs, tokenizer_path, end_id).mapInArrow(_pack(length), _PIECES)
