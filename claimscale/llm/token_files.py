"""Token ids of a corpus in binary files, in the order of doc_id, and back.

A corpus is written as a table of segments.  A segment holds whole documents:
their keys, their numbers of ids, and a Simple-8b body with all ids.  Segments
carry the number of their range partition and their number in it, which together
give the order of the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimscale.llm import simple8b
from claimscale.llm.arrow_text import chunks
from claimscale.llm.tokens import CHUNK_BYTES, encoder
from claimscale.session import shuffle_width

END_ID = 0
SEGMENT_IDS = 1_000_000

_SEGMENTS = (
    "part int, segment int, n_ids long, doc_ids array<long>, doc_tokens array<int>, body binary"
)
_DOCUMENTS = "part int, segment int, doc_id long, before long, n_tokens long"
_KEYS = [f.split()[0] for f in _DOCUMENTS.split(", ")]


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end_id`` behind those of each text."""
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))


def _segments(path: str, end_id: int, segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = encoder(path).encode
        number, keys, sizes, held, n_held = 0, [], [], [], 0

        def flush() -> pa.RecordBatch:
            counts = np.concatenate(sizes)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([n_held], pa.int64()),
                    pa.array([[k for some in keys for k in some]], pa.list_(pa.int64())),
                    pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([simple8b.encode(np.concatenate(held))], pa.binary()),
                ],
                names=[f.split()[0] for f in _SEGMENTS.split(", ")],
            )

        for rows, data, offsets in chunks(batches, limit=CHUNK_BYTES):
            ids, bounds = with_end(*encode(data, offsets), end_id)
            keys.append(rows.column("doc_id").to_pylist())
            sizes.append(np.diff(bounds))
            held.append(ids)
            n_held += len(ids)
            if n_held >= segment_ids:
                yield flush()
                number, keys, sizes, held, n_held = number + 1, [], [], [], 0
        if keys:
            yield flush()

    return run


def write_token_files(
    docs: DataFrame,
    target: str,
    tokenizer_path: str,
    end_id: int = END_ID,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encode every text of ``docs`` (doc_id, text) and write the segments to ``target``.

    Documents are ordered by doc_id, nulls first; rows that repeat a doc_id are
    ordered by text.  A null or empty text has the end id only.  An empty table
    gives a table without segments.  Other columns are not read.
    """
    n = shuffle_width(docs.sparkSession)
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(n, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_segments(tokenizer_path, end_id, segment_ids), _SEGMENTS)
        .write.parquet(target)
    )


def _documents(checksums: bool):
    """Rows of _DOCUMENTS; with ``checksums`` a checksum instead of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = simple8b.decode(row["body"]).astype("<u4")
                counts = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(counts)
                if len(ids) != row["n_ids"] or (ends[-1] if len(ends) else 0) != len(ids):
                    raise ValueError("a segment's body does not have the ids it says")
                n, first, blob = len(counts), 0, ids.tobytes()
                # Ids are four bytes each: some megabytes of them at a time.
                while first < n:
                    begin = int(ends[first] - counts[first])
                    last = max(int(np.searchsorted(ends, begin + (1 << 20), "right")), first + 1)
                    bounds = [begin, *ends[first:last].tolist()]
                    found = [blob[4 * a : 4 * b] for a, b in zip(bounds, bounds[1:])]
                    if checksums:
                        found = pa.array([zlib.crc32(x) for x in found], pa.int64())
                    else:
                        found = pa.array(found, pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["part"]] * (last - first), pa.int32()),
                            pa.array([row["segment"]] * (last - first), pa.int32()),
                            pa.array(row["doc_ids"][first:last], pa.int64()),
                            pa.array(bounds[:-1], pa.int64()),
                            pa.array(counts[first:last], pa.int64()),
                            found,
                        ],
                        names=[*_KEYS, "ids_crc32" if checksums else "ids"],
                    )
                    first = last

    return run


def segment_starts(segments: DataFrame) -> DataFrame:
    """part, segment, and the number of ids of all segments before."""
    before = Window.rowsBetween
    sizes = segments.select("part", "segment", "n_ids")
    whole = before(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select(
        "part", F.coalesce(F.sum("n").over(whole.orderBy("part")), F.lit(0)).alias("part_start")
    )
    inside = F.sum("n_ids").over(whole.partitionBy("part").orderBy("segment"))
    return sizes.join(parts, "part").select(
        "part", "segment", (F.col("part_start") + F.coalesce(inside, F.lit(0))).alias("seg_start")
    )


def read_token_files(segments: DataFrame, checksums: bool = False) -> DataFrame:
    """The documents of a table of segments.

    Returns doc_id, start long (ids of all documents before it), n_tokens long (with
    the end id) and ids binary (little-endian unsigned 32-bit), or with
    ``checksums`` ids_crc32 long instead of the ids.
    """
    last = "ids_crc32 long" if checksums else "ids binary"
    found = segments.mapInArrow(_documents(checksums), f"{_DOCUMENTS}, {last}")
    return found.join(segment_starts(segments), ["part", "segment"]).select(
        "doc_id", (F.col("seg_start") + F.col("before")).alias("start"), "n_tokens", last.split()[0]
    )
