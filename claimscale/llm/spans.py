"""Stretches of one array: gathered side by side, or numbered by what they hold."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches ``values[start : start + size]`` one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    places = np.repeat(starts - (ends - sizes), sizes)
    places += np.arange(total)
    return values[places]


def strings(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The stretches of some bytes as an Arrow column."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    held = gather(data, starts, sizes)
    return pa.Array.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(held)]
    )


def numbered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number per stretch, equal where all bytes are, and the contents by number."""
    coded = strings(data, starts, sizes).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    known = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8), known
