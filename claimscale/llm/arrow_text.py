"""Whole texts inside a task: Arrow batches as byte arrays, words and their hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20

# The white space of the word rule `[^\x20\x09-\x0D]+`.  All of it is ASCII, so
# words can be cut in UTF-8 bytes.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)


def chunks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into pieces of about ``limit`` bytes of text.

    Yields the rows, their text as one array of bytes (null: empty) and the
    offsets of the rows in it.  A text is never cut, so a piece holds one text
    at least.
    """
    for batch in batches:
        texts = batch.column(column).cast(pa.large_binary())
        if texts.null_count:
            texts = texts.fill_null(b"")
        if not len(texts):
            continue
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[
            texts.offset : texts.offset + len(texts) + 1
        ]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right"))
            last = min(max(last - 1, first + 1), len(texts))
            begin, end = int(offsets[first]), int(offsets[last])
            yield (
                batch.slice(first, last - first),
                data[begin:end],
                offsets[first : last + 1] - begin,
            )
            first = last


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one, in place."""
    h ^= h >> _SHIFT
    h *= _MULTIPLIER
    h ^= h >> _SHIFT
    h *= _MULTIPLIER
    h ^= h >> _SHIFT
    return h


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts and ends of all words, and for each text the number of its first word.

    Words never reach across texts.
    """
    space = np.ones(len(data) + 1, bool)
    space[:-1] = _IS_SPACE[data]
    begins = ~space[:-1]
    begins[1:] &= space[:-2]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cut] = ~space[cut]
    ends = ~space[:-1] & space[1:]
    ends[cut - 1] = ~space[cut - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # masks of the first bytes
_STEP = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0
) -> np.ndarray:
    """A 64-bit hash of each word; other seeds give independent ones.

    Each eight bytes are mixed together with their place before they are summed up, so
    no arrangement of equal parts makes different words alike.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    pieces = np.maximum((sizes + 7) >> 3, 1)
    first = np.cumsum(pieces) - pieces
    place = np.arange(int(pieces.sum())) - np.repeat(first, pieces)
    at = np.repeat(starts, pieces) + 8 * place
    left = np.minimum(np.repeat(sizes, pieces) - 8 * place, 8)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).tobytes()
    loads = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, 0, (1,))
    value = loads[at] & _FIRST[left]
    salt = np.uint64(seed * 0x5851F42D4C957F2D % (1 << 64))
    value += (place + 1).astype(np.uint64) * _STEP + salt
    sums = np.add.reduceat(mixed(value), first)
    return mixed(sums ^ mixed(sizes.astype(np.uint64) + salt))
