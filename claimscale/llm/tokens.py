"""Token ids of whole texts, from a tokenizers file.

Byte-level BPE splits a text into pre-tokens by a pattern that never looks back,
so a text may be cut at any place where a pre-token surely ends, and each piece
encoded once and remembered.  Pieces are found, hashed and looked up for millions
of bytes at a time; only pieces not met before go through the tokenizer.
"""

from __future__ import annotations

import json
import os

import numpy as np

from claimscale.llm.arrow_text import mixed

CHUNK_BYTES = 2 << 20  # of text encoded at once; the arrays in use are some 40 times that
INLINE = 15
MAX_ENTRIES = 1_500_000

_ASCII = np.arange(256)
_GRAPH = (_ASCII > 0x20) & (_ASCII < 0x7F)
_LETTER = ((_ASCII | 0x20) >= ord("a")) & ((_ASCII | 0x20) <= ord("z")) & (_ASCII < 0x80)
_DIGIT = (_ASCII >= ord("0")) & (_ASCII <= ord("9"))
_SIGN = _GRAPH & ~_LETTER & ~_DIGIT
_BLANK = (_ASCII == 0x20) | ((_ASCII >= 0x09) & (_ASCII <= 0x0D))
# Lead byte of the letters from U+00C0 to U+00FF (but for two signs among them).
_LATIN = 0xC3
_ONES = [(1 << 8 * min(n, 8)) - 1 for n in range(INLINE + 1)]
_LOW = np.array(_ONES, np.uint64)
_HIGH = np.array([(1 << 8 * max(n - 8, 0)) - 1 for n in range(INLINE + 1)], np.uint64)


def piece_starts(data: np.ndarray, offsets: np.ndarray, whole: list[bytes] = ()) -> np.ndarray:
    """Positions where a pre-token surely starts, whatever stands around.

    These are the starts of texts; white space after a sign or letter; a sign
    after a letter; and what follows a single line feed between visible signs.
    Nothing is cut inside an occurrence of one of ``whole``.
    """
    n = len(data)
    before, two = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    before[1:], two[2:] = data[:-1], data[:-2]
    latin = (two == _LATIN) & (before >= 0x80)
    visible = _GRAPH[before] | latin
    letter = _LETTER[before] | (latin & (before != 0x97) & (before != 0xB7))
    start = (_BLANK[data] & visible) | (_SIGN[data] & letter)
    feed = np.zeros(n, bool)
    feed[1:] = (data[:-1] == 0x0A) & visible[:-1]
    start |= feed & (_GRAPH[data] | (data == _LATIN))
    joined = data.tobytes() if len(whole) else b""
    for token in whole:
        found = joined.find(token)
        while found >= 0:
            start[found + 1 : found + len(token)] = False
            found = joined.find(token, found + 1)
    start[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(start)


class _Memory:
    """Ids of the pieces met so far: an open-addressing table over arrays."""

    def __init__(self) -> None:
        self.low = np.zeros(1 << 16, np.uint64)
        self.high = np.zeros(1 << 16, np.uint64)
        self.entry = np.zeros(1 << 16, np.int64)
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.long: dict[bytes, int] = {}

    def __len__(self) -> int:
        return len(self.starts) - 1

    def _home(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        h = mixed(low ^ (high * np.uint64(0x9E3779B97F4A7C15)))
        return (h & np.uint64(len(self.low) - 1)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Entries, -1 where a piece is not known."""
        at, out = self._home(low, high), np.full(len(low), -1, np.int64)
        left = np.arange(len(low))
        mask = len(self.low) - 1
        while len(left):
            slot = at[left]
            used = self.high[slot]
            hit = (used == high[left]) & (self.low[slot] == low[left])
            out[left[hit]] = self.entry[slot[hit]]
            left = left[~hit & (used != 0)]
            at[left] = (at[left] + 1) & mask
        return out

    def _place(self, low: np.ndarray, high: np.ndarray, entry: np.ndarray) -> None:
        at, left, mask = self._home(low, high), np.arange(len(low)), len(self.low) - 1
        while len(left):
            free = self.high[at[left]] == 0
            mine, slot = left[free], at[left[free]]
            self.low[slot], self.high[slot], self.entry[slot] = low[mine], high[mine], entry[mine]
            won = np.zeros(len(low), bool)
            won[mine] = self.entry[slot] == entry[mine]
            left = left[~won[left]]
            at[left] = (at[left] + 1) & mask

    def add(self, ids: list[list[int]]) -> int:
        """Append entries; the number of the first."""
        first = len(self)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        flat = np.fromiter((i for one in ids for i in one), np.uint32, int(sizes.sum()))
        self.ids = np.concatenate([self.ids, flat])
        return first

    def learn(self, low: np.ndarray, high: np.ndarray, first: int) -> None:
        while 4 * (len(self) + 1) > 3 * len(self.low):
            full = np.flatnonzero(self.high)
            old = self.low[full], self.high[full], self.entry[full]
            size = 2 * len(self.low)
            self.low, self.high = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
            self.entry = np.zeros(size, np.int64)
            self._place(*old)
        self._place(low, high, np.arange(first, first + len(low)))


class Encoder:
    """Ids of many texts at once; equal to encoding each whole text by itself."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        cut = said.get("pre_tokenizer") or {}
        self.splits = (
            said.get("normalizer") is None
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space", True)
        )
        added = said.get("added_tokens", [])
        self.whole = [t["content"].encode() for t in added]
        self.splits &= not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        self.memory = _Memory()

    def _ids(self, pieces: list[bytes]) -> list[list[int]]:
        texts = [p.decode("utf-8", "replace") for p in pieces]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in found]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where the ids of each text start (one more than texts)."""
        if not self.splits:
            texts = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
            ids = self._ids(texts)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((i for one in ids for i in one), np.uint32, int(sizes.sum()))
            return flat, np.concatenate([[0], np.cumsum(sizes)])
        if len(self.memory) > MAX_ENTRIES:
            self.memory = _Memory()
        memory = self.memory
        starts = piece_starts(data, offsets, self.whole)
        sizes = np.diff(np.append(starts, len(data)))
        short = sizes <= INLINE
        entries = np.empty(len(starts), np.int64)

        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        loads = np.ndarray((len(data) + 9,), np.dtype("<u8"), padded.tobytes(), 0, (1,))
        at, size = starts[short], sizes[short]
        low = loads[at] & _LOW[size]
        high = loads[np.minimum(at + 8, len(loads) - 1)] & _HIGH[size]
        high |= size.astype(np.uint64) << np.uint64(56)
        found = memory.find(low, high)
        new = np.flatnonzero(found < 0)
        if len(new):
            both = np.stack([low[new], high[new]], 1).view("V16").ravel()
            _, pick, back = np.unique(both, return_index=True, return_inverse=True)
            pick = new[pick]
            pieces = [data[a : a + n].tobytes() for a, n in zip(at[pick], size[pick])]
            first = memory.add(self._ids(pieces))
            memory.learn(low[pick], high[pick], first)
            found[new] = first + back.ravel()
        entries[short] = found

        rest = np.flatnonzero(~short)
        if len(rest):
            pieces = [data[a : a + n].tobytes() for a, n in zip(starts[rest], sizes[rest])]
            new = [p for p in dict.fromkeys(pieces) if p not in memory.long]
            first = memory.add(self._ids(new))
            fresh = {p: first + i for i, p in enumerate(new)}
            entries[rest] = [fresh[p] if p in fresh else memory.long[p] for p in pieces]
            # Very long pieces hardly come again.
            memory.long.update((p, e) for p, e in fresh.items() if len(p) <= 200)

        counts = memory.starts[entries + 1] - memory.starts[entries]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(memory.starts[entries] - (ends - counts), counts)
        ids = memory.ids[shift + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.searchsorted(starts, offsets)]
        return ids, bounds


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process; what it remembers serves later tasks too."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget() -> None:
    """Drop what this worker process remembers of texts; it is learned anew when needed."""
    _encoders.clear()
