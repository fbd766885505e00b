"""Byte-level BPE by speculation: propose tokens greedily, verify, merge only what fails.

A sequence of tokens is what merging gives if and only if no merge ever reaches
across the seam of two neighbours while they are being built.  So a word's tokens
can be guessed - the longest match at each place - and each pair of neighbours be
tested by itself, for all words at once.  Only words with a failing pair are merged.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from claimscale.llm.arrow_text import chunks
from claimscale.llm.spans import buffers, gather, numbered

CHUNK_BYTES = 2 << 20
REMEMBERED = 400_000  # words kept by a worker; then it starts anew
LONG_WORD = 64  # bytes; longer words hardly come again
NEVER = np.iinfo(np.int64).max

# Classes of code points in the pattern of byte-level pre-tokens.
UNKNOWN, LETTER, NUMBER, OTHER, SPACE = range(5)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it is visible, else the next free one."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Tokens and merges of a byte-level tokenizers file, as arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model, cut, added = said["model"], said.get("pre_tokenizer") or {}, said["added_tokens"]
        supported = (
            model["type"] == "BPE"
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space", True)
            and said.get("normalizer") is None
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
            and not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges"))
            and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix"))
        )
        if not supported:
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in added}
        spelt = {i: bytes(byte_of[c] for c in token) for token, i in self.ids.items()}
        spelt |= {i: content for content, i in self.special.items()}
        self.size = max(spelt) + 1
        self.bytes = [spelt.get(i, b"") for i in range(self.size)]
        self.of_byte = np.array([self.ids.get(letter, -1) for letter in byte_letters()])
        if (self.of_byte < 0).any():
            raise ValueError(f"{path} lacks tokens of single bytes")
        self._read_merges(model["merges"])
        self._build_trie()

    def _read_merges(self, merges: list) -> None:
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        left = np.array([self.ids[a] for a, _ in pairs], np.int64)
        right = np.array([self.ids[b] for _, b in pairs], np.int64)
        made = np.array([self.ids[a + b] for a, b in pairs], np.int64)
        rank = np.arange(len(pairs))
        self.merges = dict(zip(zip(left.tolist(), right.tolist()), zip(rank.tolist(), made.tolist())))
        # When a token is made, and of what; single bytes always exist.
        self.made_at = np.full(self.size, -1, np.int64)
        self.left, self.right = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        self.made_at[made], self.left[made], self.right[made] = rank, left, right
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_rank = keys[order], rank[order]
        # Each token is made in one way, after its parts, or no pair tells what merging does.
        known = self.made_at[left] < rank
        known &= self.made_at[right] < rank
        once = len(set(made.tolist())) == len(made) == len(self.merges)
        self.speculates = bool(once and known.all() and not np.isin(made, self.of_byte).any())
        # A token may be proposed if merging its bytes gives it, and nothing else.
        usable = np.zeros(self.size, bool)
        usable[self.of_byte] = True
        whole = self.compatible(left, right, 3 * rank + 1)
        for one, a, b, ok in zip(made.tolist(), left.tolist(), right.tolist(), whole.tolist()):
            usable[one] = ok and usable[a] and usable[b]
        self.usable = usable

    def _build_trie(self) -> None:
        edges: dict[int, int] = {}
        token_at = [-1]
        for token in np.flatnonzero(self.usable).tolist():
            node = 0
            for b in self.bytes[token]:
                key = node << 8 | b
                if key not in edges:
                    edges[key] = len(token_at)
                    token_at.append(-1)
                node = edges[key]
            token_at[node] = token
        keys = np.fromiter(edges, np.int64, len(edges))
        order = np.argsort(keys)
        self.edge_keys = keys[order]
        self.edge_nodes = np.fromiter(edges.values(), np.int64, len(edges))[order]
        self.token_at = np.array(token_at)

    def compatible(
        self, left: np.ndarray, right: np.ndarray, until: np.ndarray | None = None
    ) -> np.ndarray:
        """Whether merging leaves the seam between each two neighbours alone.

        Time is 3 * rank, and of equal merges the left one comes first: one inside
        the left token at 3 * rank, one over the seam a step later, one inside the
        right token after that.  Both tokens are taken apart backwards in time; at
        each stage the two parts at the seam must not have merged before the next.
        ``until`` is when the seam may go at last.
        """
        left, right = left.copy(), right.copy()
        end = np.full(len(left), NEVER) if until is None else until.copy()
        good = np.ones(len(left), bool)
        live = np.arange(len(left))
        while len(live):
            a, b = left[live], right[live]
            keys = a * self.size + b
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            merges = self.pair_keys[at] == keys if len(self.pair_keys) else np.zeros(len(at), bool)
            bad = np.zeros(len(live), bool)
            bad[merges] = 3 * self.pair_rank[at[merges]] + 1 < end[live[merges]]
            good[live[bad]] = False
            time_a, time_b = 3 * self.made_at[a], 3 * self.made_at[b] + 2
            of_left = time_a > time_b
            end[live] = np.where(of_left, time_a, time_b)
            left[live] = np.where(of_left, self.right[a], a)
            right[live] = np.where(of_left, b, self.left[b])
            live = live[~bad & ((time_a >= 0) | (time_b >= 2))]
        return good

    def longest(self, data: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each byte the longest token from there on, ending at ``stop`` at most."""
        token, size = np.full(len(data), -1), np.zeros(len(data), np.int64)
        live, node = np.arange(len(data)), np.zeros(len(data), np.int64)
        depth = 0
        while len(live):
            keys = node << 8 | data[live + depth]
            at = np.minimum(np.searchsorted(self.edge_keys, keys), len(self.edge_keys) - 1)
            on = self.edge_keys[at] == keys
            live, node = live[on], self.edge_nodes[at[on]]
            depth += 1
            found = self.token_at[node]
            ends = found >= 0
            token[live[ends]], size[live[ends]] = found[ends], depth
            on = live + depth < stop[live]
            live, node = live[on], node[on]
        return token, size

    def merged(self, word: bytes) -> list[int]:
        """Ids of a word by merging: always the first of the pairs of the lowest rank."""
        ids = [int(self.of_byte[b]) for b in word]
        before, after = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
        queue = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(ids):
                known = self.merges.get((ids[i], ids[j]))
                if known:
                    heapq.heappush(queue, (known[0], i, ids[i], ids[j], known[1]))

        for i in range(len(ids) - 1):
            offer(i)
        while queue:
            _, i, a, b, made = heapq.heappop(queue)
            j = after[i]
            # What has changed since it was offered is offered anew.
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [i for i in ids if i >= 0]

    def propose(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy tokens of many words: ids, and the word of each; words in order."""
        sizes = np.diff(offsets)
        token, size = self.longest(data, np.repeat(offsets[1:], sizes))
        at, word = offsets[:-1][sizes > 0], np.flatnonzero(sizes)
        stop = offsets[1:][sizes > 0]
        found = []
        while len(at):
            found.append((at, word))
            at = at + size[at]
            on = at < stop
            at, word, stop = at[on], word[on], stop[on]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, word = (np.concatenate(part) for part in zip(*found))
        order = np.argsort(at)
        return token[at[order]], word[order]

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids of many words, how many each has, and how many words had to be merged."""
        n = len(offsets) - 1
        if self.speculates:
            ids, word = self.propose(data, offsets)
            same = np.flatnonzero(word[1:] == word[:-1])
            pairs = ids[same] * self.size + ids[same + 1]
            distinct, back = np.unique(pairs, return_inverse=True)
            good = self.compatible(distinct // self.size, distinct % self.size)[back]
            failed = np.unique(word[same[~good]])
        else:
            ids = word = np.zeros(0, np.int64)
            failed = np.arange(n)
        if len(failed):
            keep = ~np.isin(word, failed)
            exact = [self.merged(data[offsets[w] : offsets[w + 1]].tobytes()) for w in failed]
            sizes = [len(one) for one in exact]
            ids = np.concatenate([ids[keep], np.array([i for one in exact for i in one], np.int64)])
            word = np.concatenate([word[keep], np.repeat(failed, sizes)])
            order = np.argsort(word, kind="stable")
            ids, word = ids[order], word[order]
        return ids, np.bincount(word, minlength=n), len(failed)


class Codec:
    """Encodes and decodes whole texts; remembers the words it has met."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers.pre_tokenizers import ByteLevel

        self.vocabulary = Vocabulary(path)
        self._cut = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, special))) if special else None
        self.spelt = np.frombuffer(b"".join(self.vocabulary.bytes), np.uint8)
        sizes = [len(b) for b in self.vocabulary.bytes]
        self.spelt_size = np.array(sizes, np.int64)
        self.spelt_at = np.cumsum(self.spelt_size) - self.spelt_size
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = [np.array([i], np.int64) for i in self.vocabulary.special.values()]
        self.sizes = [np.ones(len(self.ids), np.int64)]
        self.entries = len(self.ids)
        self.special_entry = {c: n for n, c in enumerate(self.vocabulary.special)}

    def _classes(self, points: np.ndarray) -> np.ndarray:
        """Classes of code points, as the tokenizer library's own pattern has them."""
        found = self.classes[points]
        for point in np.unique(points[found == UNKNOWN]).tolist():
            sign = chr(point)
            kinds = [k for k, c in ((LETTER, "a"), (NUMBER, "0"), (OTHER, "!")) if len(self._cut(c + sign)) == 1]
            self.classes[point] = kinds[0] if kinds else SPACE
        return self.classes[points] if (found == UNKNOWN).any() else found

    def word_starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pre-tokens start; ``offsets`` are borders that none crosses."""
        if not len(data):
            return np.zeros(0, np.int64)
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        kind = self._classes(points)
        n = len(points)
        edge = np.zeros(n + 1, bool)  # borders of texts, before code points
        edge[np.searchsorted(lead, offsets)] = True
        edge[0] = edge[n] = True
        start = edge[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        # White space: its last sign stands apart, and a blank opens the next word.
        space = kind == SPACE
        more = np.zeros(n, bool)  # something follows in the text
        more[:-1] = ~edge[1:n]
        last = space & more
        last[:-1] &= ~space[1:]
        start |= last
        blank = np.flatnonzero(last & (points == 0x20))
        start[blank + 1] = False
        # Short forms: an apostrophe that opens a word, and the letters after it.
        mark = np.flatnonzero((points == 0x27) & start)
        mark = mark[more[mark]]
        one = mark[np.isin(points[mark + 1], [ord(c) for c in "stmd"])]
        two = mark[mark + 2 < n]
        two = two[~edge[two + 2]]
        pairs = points[two + 1].astype(np.int64) << 8 | points[two + 2]
        two = two[np.isin(pairs, [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")])]
        start[one + 1] = start[two + 1] = False
        after = np.concatenate([one + 2, two + 3])
        start[after[after < n]] = True
        return lead[np.flatnonzero(start)]

    def _entries(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The entry of each word; new ones are proposed, verified and remembered."""
        number, held = numbered(data, starts, sizes)
        contents = held.to_pylist()
        entry = np.array([self.known.get(c, -1) for c in contents], np.int64)
        new = np.flatnonzero(entry < 0)
        if len(new):
            ids, counts, _ = self.vocabulary.words(*buffers(held.take(pa.array(new))))
            entry[new] = np.arange(self.entries, self.entries + len(new))
            self.ids.append(ids)
            self.sizes.append(counts)
            self.known.update(
                (contents[i], int(entry[i])) for i in new if len(contents[i]) <= LONG_WORD
            )
            self.entries += len(new)
        return entry[number]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where those of each start (one more than texts)."""
        if self.entries > REMEMBERED:
            self._forget()
        found = []
        if self.special is not None:
            for hit in self.special.finditer(data.tobytes()):
                # Texts stand side by side here: a token over their border is none.
                if np.searchsorted(offsets, hit.start(), "right") == np.searchsorted(offsets, hit.end()):
                    found.append((hit.start(), hit.end(), self.special_entry[hit.group()]))
        first = np.array([f[0] for f in found], np.int64)
        borders = np.concatenate([offsets, first, np.array([f[1] for f in found], np.int64)])
        starts = self.word_starts(data, borders)
        if found:
            inside = np.searchsorted(first, starts, "right") - 1
            stops = np.array([f[1] for f in found], np.int64)
            starts = starts[(inside < 0) | (starts == first[inside]) | (starts >= stops[inside])]
        sizes = np.diff(np.append(starts, len(data)))
        entry = self._entries(data, starts, sizes)
        if found:
            entry[np.searchsorted(starts, first)] = [f[2] for f in found]
        self.ids, self.sizes = [np.concatenate(self.ids)], [np.concatenate(self.sizes)]
        entry_size = self.sizes[0]
        entry_start = np.cumsum(entry_size) - entry_size
        counts = entry_size[entry]
        ids = gather(self.ids[0], entry_start[entry], counts)
        bounds = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, offsets)]
        return ids, bounds

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of lists of ids; an id without a token gives nothing."""
        known = (ids >= 0) & (ids < self.vocabulary.size)
        safe = np.where(known, ids, 0)
        sizes = np.where(known, self.spelt_size[safe], 0)
        spelt = gather(self.spelt, self.spelt_at[safe], sizes).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        return [spelt[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of this worker process; what it remembers serves later tasks too."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


Run = Callable[[pa.RecordBatch, int], Iterator[tuple[pa.RecordBatch, list[pa.Array]]]]


def _with_mapped(df: DataFrame, source: str, targets: dict[str, T.DataType], run: Run) -> DataFrame:
    """``df`` with ``targets`` as ``run`` makes them of ``source``; batches may be cut.

    Spark looks the columns of a mapped table up by name, and names may hold points, so
    they are numbered in between.
    """
    kept = [i for i, c in enumerate(df.columns) if c not in targets]
    at = df.columns.index(source)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    fields = [plain.schema.fields[i] for i in kept]
    made = [T.StructField(f"m{i}", kind) for i, kind in enumerate(targets.values())]
    schema = T.StructType([*fields, *made])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, columns in run(batch, at):
                columns = [*(rows.column(i) for i in kept), *columns]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return plain.mapInArrow(mapped, schema).toDF(*[df.columns[i] for i in kept], *targets)


def encode(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    ids: str = "ids",
    decoded: str | None = None,
) -> DataFrame:
    """``docs`` with ``ids`` (array<int>): the tokens of each whole text.

    They are what the tokenizers library gives for the file without adding special
    tokens; such tokens that stand in a text have their own id, as there.  The file
    has to be a plain byte-level BPE; others are an error.  With ``decoded`` a column of
    that name holds what the ids spell, as ``decode`` gives it, worked out in the same
    pass.  A null or empty text has no ids and spells nothing.  Repeated rows are encoded
    each; other columns stay as they are, whatever their names, but columns named as the
    new ones are replaced.  An empty table stays empty.  Nothing is shuffled, and a task
    holds some megabytes of text (or one text) at a time.
    """
    targets = {ids: T.ArrayType(T.IntegerType())} | ({decoded: T.StringType()} if decoded else {})

    def run(batch: pa.RecordBatch, at: int) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        known = codec(tokenizer_path)
        for rows, data, offsets in chunks(iter([batch]), batch.schema.names[at], CHUNK_BYTES):
            found, bounds = known.encode(data, offsets)
            columns = [
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(found, pa.int32()))
            ]
            if decoded:
                columns.append(pa.array(known.decode(found, bounds), pa.string()))
            yield rows, columns

    return _with_mapped(docs, text, targets, run)


def decode(df: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with ``text``: what its lists of ids spell, special tokens included.

    Null lists give null, empty ones the empty text; ids the tokenizer doesn't have, and
    null ones, give nothing; bytes that are no UTF-8 become the replacement character.
    """

    def run(batch: pa.RecordBatch, at: int) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        decoder = codec(tokenizer_path)
        lists = batch.column(at)
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        # Some megabytes of ids at a time; one row at least.
        first = 0
        while first < len(lists):
            last = int(np.searchsorted(bounds, bounds[first] + CHUNK_BYTES, "right")) - 1
            last = min(max(last, first + 1), len(lists))
            piece = flat[bounds[first] : bounds[last]]
            texts = decoder.decode(piece, bounds[first : last + 1] - bounds[first])
            empty = lists.slice(first, last - first).is_null().to_numpy(zero_copy_only=False)
            yield batch.slice(first, last - first), [pa.array(texts, pa.string(), mask=empty)]
            first = last

    return _with_mapped(df, ids, {text: T.StringType()}, run)
