"""Simple-8b: word-aligned coding of whole numbers, encoded and decoded by arrays.

A 64-bit word holds a selector in its low four bits and, above it, as many values
of equal width as the selector says.  Values of more than 60 bits follow an escape
word as they are.  Values are coded in blocks of 128 that begin at a word of their
own; the offsets of the blocks stand in front, so that all blocks of a file are
decoded side by side.
"""

from __future__ import annotations

import numpy as np

# --- fixed values: how many values of how many bits each selector packs ---------
# Selector 0 is the escape.
COUNTS = [1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
WIDTHS = [64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60]
# --------------------------------------------------------------------------------

BLOCK = 128
MAGIC = 0x5338_4231
_COUNTS = np.array(COUNTS + [1], np.int64)
_HEADER = np.dtype([("magic", "<u4"), ("block", "<u4"), ("values", "<u8"), ("words", "<u8")])


def _selectors(values: np.ndarray) -> np.ndarray:
    """For each value the selector that packs most values from there on.

    ``values`` has a column per block.  A word may reach past the end of its
    block: the decoder knows the count.
    """
    length, lanes = values.shape
    best = np.zeros((length, lanes), np.uint8)
    # Bit lengths from the exponents of floats: never too small, and one too large
    # at most, for values that a float rounds up to a power of two.
    exponents = values.astype(np.float64).view(np.int64) >> 52
    bits = np.maximum(exponents - 1022, 0).astype(np.uint8)
    for selector in range(len(COUNTS) - 1, 0, -1):
        fits = (bits <= WIDTHS[selector]).astype(np.uint8)
        # How many values, from here on, are narrow enough.
        run = np.full(lanes, 64, np.uint8)
        for i in range(length - 1, -1, -1):
            run += run < 128
            run *= fits[i]
            np.putmask(best[i], run >= COUNTS[selector], selector)
    return best


def encode(values: np.ndarray) -> bytes:
    """One file body: header, block offsets, words."""
    values = np.asarray(values).astype(np.uint64)
    n = len(values)
    lanes = -(-n // BLOCK)
    # One column per block, and zeros behind its end.
    table = np.zeros((BLOCK + 64, lanes), np.uint64)
    sizes = np.full(lanes, BLOCK, np.int64)
    if lanes:
        sizes[-1] = n - (lanes - 1) * BLOCK
        flat = np.zeros(lanes * BLOCK, np.uint64)
        flat[:n] = values
        table[:BLOCK] = flat.reshape(lanes, BLOCK).T
    best = _selectors(table[:BLOCK])
    at = np.zeros(lanes, np.int64)
    steps, live = [], np.arange(lanes)
    while len(live):
        chosen = best[at[live], live]
        word = chosen.astype(np.uint64)
        for selector in np.flatnonzero(np.bincount(chosen)):
            if selector:
                mine = np.flatnonzero(chosen == selector)
                lane = live[mine]
                packed = word[mine]
                for j in range(COUNTS[selector]):
                    packed |= table[at[lane] + j, lane] << np.uint64(4 + j * WIDTHS[selector])
                word[mine] = packed
        steps.append((live, word))
        escaped = live[chosen == 0]
        if len(escaped):
            steps.append((escaped, table[at[escaped], escaped]))
        at[live] += _COUNTS[chosen]
        live = live[at[live] < sizes[live]]
    # Words came step by step; their order is block by block.
    grid = np.zeros((lanes, len(steps)), np.uint64)
    there = np.zeros((lanes, len(steps)), bool)
    for i, (lane, word) in enumerate(steps):
        grid[lane, i] = word
        there[lane, i] = True
    words = grid[there]
    offsets = np.concatenate([[0], np.cumsum(there.sum(1))])
    header = np.array([(MAGIC, BLOCK, n, len(words))], _HEADER)
    return header.tobytes() + offsets.astype("<u4").tobytes() + words.astype("<u8").tobytes()


def decode(body: bytes) -> np.ndarray:
    """The values of a file body."""
    header = np.frombuffer(body, _HEADER, 1)[0]
    if header["magic"] != MAGIC:
        raise ValueError("no Simple-8b body")
    n, block, n_words = int(header["values"]), int(header["block"]), int(header["words"])
    lanes = -(-n // block)
    offsets = np.frombuffer(body, "<u4", lanes + 1, _HEADER.itemsize).astype(np.int64)
    words = np.frombuffer(body, "<u8", n_words, _HEADER.itemsize + 4 * (lanes + 1))
    chosen = (words & np.uint64(15)).astype(np.int64)
    raw = np.zeros(n_words, bool)
    for i in np.flatnonzero(chosen == 0):
        # A word behind an escape is a value, whatever its low bits say.
        if not raw[i]:
            raw[i + 1] = True
    counts = np.where(raw, 0, _COUNTS[chosen])
    ends = np.cumsum(counts)
    # Where each word's values go: behind those of its block so far.
    lane = np.repeat(np.arange(lanes), np.diff(offsets))
    base = np.concatenate([[0], ends])[offsets[:-1]]
    begin = lane * block + (ends - counts) - base[lane]
    limit = np.minimum((lane + 1) * block, n)
    out = np.zeros(n, np.uint64)
    for selector in np.unique(chosen[~raw]):
        at = np.flatnonzero((chosen == selector) & ~raw)
        if selector == 0:
            out[begin[at]] = words[at + 1]
            continue
        mask = np.uint64((1 << WIDTHS[selector]) - 1)
        for j in range(COUNTS[selector]):
            to = begin[at] + j
            inside = to < limit[at]
            value = (words[at[inside]] >> np.uint64(4 + j * WIDTHS[selector])) & mask
            out[to[inside]] = value
    return out
