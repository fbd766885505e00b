"""Removing repeated passages with Aho-Corasick automata.

Passages of so many words that occur more than once are confirmed on the words
themselves, compiled into automata, shared out by the passages' anchors, and every
candidate stretch of every document goes through the automaton of its share, which
locates all occurrences.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscale.llm import repeats
from claimscale.llm.arrow_text import word_hashes, words
from claimscale.llm.rows import ordered_key

LENGTH = 35
GRAM = 10
PATTERNS = 4_000  # in one automaton, some hundred megabytes of nodes

_CUT = (
    "doc long, n_words long, n_removed long, kept_sha256 string,"
    " starts array<long>, ends array<long>, kept string"
)


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = words(data, offsets)
    return word_hashes(data, starts, ends), first


def confirmed(contents: list[list[bytes]], members: list[int], length: int) -> list[list[int]]:
    """For each content the starts of the passages that occur more than once.

    A content that several documents share occurs that often by itself.
    """
    seen: Counter = Counter()
    for found, n in zip(contents, members):
        for i in range(len(found) - length + 1):
            seen[b" ".join(found[i : i + length])] += n
    return [
        [
            i
            for i in range(len(found) - length + 1)
            if seen[b" ".join(found[i : i + length])] > 1
        ]
        for found in contents
    ]


def tiles(starts: list[int], length: int) -> list[int]:
    """Some of the passages that together cover what all of them cover."""
    chosen: list[int] = []
    for i, start in enumerate(starts):
        ends_run = i + 1 == len(starts) or starts[i + 1] != start + 1
        begins_run = i == 0 or starts[i - 1] != start - 1
        if begins_run or ends_run or start >= chosen[-1] + length:
            chosen.append(start)
    return chosen


def automata(patterns: list[str], most: int = PATTERNS) -> Iterator[ahocorasick.Automaton]:
    """Automata over at most so many patterns each; each is dropped before the next."""
    for i in range(0, len(patterns), most):
        automaton = ahocorasick.Automaton()
        for pattern in patterns[i : i + most]:
            automaton.add_word(pattern, True)
        automaton.make_automaton()
        yield automaton


def _resolve(length: int, most: int = PATTERNS):
    def run(table: pa.Table) -> pa.Table:
        contents = [c.split() for c in table.column("content").to_pylist()]
        recurring = confirmed(contents, table.column("members").to_pylist(), length)
        # Latin-1 keeps bytes as they are; blanks on both sides keep words whole.
        patterns: dict[str, None] = {}
        for found, starts in zip(contents, recurring):
            for i in tiles(starts, length):
                patterns[_line(found[i : i + length])] = None
        lines = [_line(found) for found in contents]
        spans: list[list[int]] = [[] for _ in lines]
        for automaton in automata(list(patterns), most):
            for line, ends in zip(lines, spans):
                ends.extend(end for end, _ in automaton.iter(line))
        out = {"anchor": [], "seg": [], "starts": [], "ends": []}
        rows = zip(table.column("anchor").to_pylist(), table.column("seg").to_pylist(), lines, spans)
        for anchor, seg, line, ends in rows:
            if ends:
                blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 0x20)
                # A match ends at the blank behind its last word.
                last = np.searchsorted(blanks, np.array(ends))
                a, b = repeats.merged(last - length, last)
                out["anchor"].append(anchor)
                out["seg"].append(seg)
                out["starts"].append(a.tolist())
                out["ends"].append(b.tolist())
        return pa.table(
            {
                "anchor": pa.array(out["anchor"], pa.int64()),
                "seg": pa.array(out["seg"], pa.int64()),
                "starts": pa.array(out["starts"], pa.list_(pa.int32())),
                "ends": pa.array(out["ends"], pa.list_(pa.int32())),
            }
        )

    return run


def _line(found: list[bytes]) -> str:
    return (b" " + b" ".join(found) + b" ").decode("latin-1")


def _cut_words(length: int):
    def cut(text: bytes, wanted: list[tuple[int, int]]) -> list[bytes]:
        found = text.split()
        return [b" ".join(found[first : last + length]) for first, last in wanted]

    return cut


def _word_windows(length: int):
    def windows(content: bytes) -> list[bytes]:
        found = content.split()
        return [b" ".join(found[i : i + length]) for i in range(len(found) - length + 1)]

    return windows


def _apply(with_rest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                found = repeats.unpack(row["packed"]).split()
                spans = np.array([(s["start"], s["end"]) for s in row["spans"] or []], np.int64)
                starts, ends = repeats.merged(*spans.reshape(-1, 2).T)
                edges = [0, *(e for span in zip(starts, ends) for e in span), len(found)]
                kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in found[a:b]]
                text = b" ".join(kept)
                out.append(
                    (
                        row["doc"],
                        len(found),
                        len(found) - len(kept),
                        hashlib.sha256(text).hexdigest(),
                        starts.tolist() if with_rest else None,
                        ends.tolist() if with_rest else None,
                        text.decode("utf-8", "replace") if with_rest else None,
                    )
                )
            kinds = [pa.int64()] * 3 + [pa.string()] + [pa.list_(pa.int64())] * 2 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                names=[f.split()[0] for f in _CUT.split(", ")],
            )

    return run


def remove_passages(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    with_rest: bool = True,
    many_classes: int = repeats.MANY_CLASSES,
    patterns: int = PATTERNS,
) -> DataFrame:
    """Remove every word covered by a passage of ``length`` words that occurs elsewhere too.

    Words are runs of `[^\\x20\\x09-\\x0D]`, unchanged (null texts: none); passages lie
    within one document, may repeat within it, and are judged on the input.  Returns
    one row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 (of the kept
    words joined by one space), and with ``with_rest`` starts, ends (of the removed
    stretches, in words) and kept (the kept words, joined).  Rows that repeat a
    document are documents of their own, so their passages recur; documents shorter
    than ``length`` words stay whole; an empty table gives no rows; other columns are
    not read.
    """
    numbered = ordered_key(docs)
    spans = repeats.written_stretches(
        numbered,
        word_units,
        length,
        gram,
        _cut_words(length),
        _word_windows(length),
        _resolve(length, patterns),
        earlier_only=False,
        many_classes=many_classes,
    )
    spans = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    texts = repeats.packed_texts(numbered)
    cut = texts.join(spans, "doc", "left").mapInArrow(_apply(with_rest), _CUT)
    if "doc_id" in numbered.columns:
        cut = cut.join(numbered.select("doc", "doc_id"), "doc").drop("doc")
    else:
        cut = cut.withColumnRenamed("doc", "doc_id")
    rest = ["starts", "ends", "kept"] if with_rest else []
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256", *rest)
