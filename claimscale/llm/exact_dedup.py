"""Exact de-duplication by Grace hashing.

Records are partitioned by a hash of their content until each bucket fits an
open-addressing table that compares complete contents.  Spark's shuffle and the
tables it writes to the shared folder are the spill files: a bucket that finds
its table full writes the records it could not place, and the next level
partitions those anew with another hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscale.llm.rows import row_key
from claimscale.session import shuffle_width
from claimscale.sources.staging import stage

TABLE_BYTES = 48 << 20
ENTRY_BYTES = 100  # of a table, besides the content
MAX_LEVELS = 60

_SPILL = (
    "row_id long, row_key long, sha string, part int, h long, ord long, nth long,"
    " home int, home_ord long, content binary"
)


class ContentTable:
    """Open addressing with linear probing; entries are compared byte for byte."""

    def __init__(self) -> None:
        self.slots = [-1] * 64
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, h: int, content: bytes) -> int:
        """The entry of an equal content, or -1."""
        mask = len(self.slots) - 1
        at = (h ^ (h >> 29)) & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return entry
            at = (at + 1) & mask
        return -1

    def add(self, h: int, content: bytes) -> int:
        """Enter a content that is not there yet."""
        if 2 * len(self.hashes) >= len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for entry, known in enumerate(self.hashes):
                self._place(known, entry)
        entry = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + ENTRY_BYTES
        self._place(h, entry)
        return entry

    def _place(self, h: int, entry: int) -> None:
        mask = len(self.slots) - 1
        at = (h ^ (h >> 29)) & mask
        while self.slots[at] >= 0:
            at = (at + 1) & mask
        self.slots[at] = entry


def _collapse(table_bytes: int):
    """Before the shuffle: of the copies within a task, only the first keeps its content.

    ``ord`` numbers the contents of one hash within the task, ``nth`` the rows of
    one content and key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        table, ords, seen, used = ContentTable(), {}, {}, {}
        for batch in batches:
            cols = batch.to_pydict()
            ord_out, nth_out, content_out = [], [], []
            for key, h, content in zip(cols["row_key"], cols["h"], cols["content"]):
                entry = table.find(h, content)
                new = entry < 0
                if new:
                    if table.bytes > table_bytes:
                        table, ords, seen = ContentTable(), {}, {}
                    entry = table.add(h, content)
                    ords[entry] = used.get(h, 0)
                    used[h] = ords[entry] + 1
                nth = seen.get((entry, key), 0)
                seen[entry, key] = nth + 1
                ord_out.append(ords[entry])
                nth_out.append(nth)
                content_out.append(content if new else None)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_id"),
                    batch.column("row_key"),
                    batch.column("sha"),
                    pa.array([part] * n, pa.int32()),
                    batch.column("h"),
                    pa.array(ord_out, pa.int64()),
                    pa.array(nth_out, pa.int64()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.int64()),
                    pa.array(content_out, pa.binary()),
                ],
                names=[f.split()[0] for f in _SPILL.split(",")],
            )

    return run


def _bucket(table_bytes: int):
    """One bucket: every content gets the first of its equals as its home.

    Contents that find the table full keep their text, for the next level.  No
    equal of theirs is in the table, and all their equals come here too, so
    nothing is lost between levels.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, homes = ContentTable(), []
        for batch in batches:
            cols = batch.to_pydict()
            home, home_ord, left = [], [], []
            for part, h, order, content in zip(
                cols["part"], cols["h"], cols["ord"], cols["content"]
            ):
                entry = -1
                if content is not None:
                    entry = table.find(h, content)
                    if entry < 0 and (table.bytes <= table_bytes or not homes):
                        entry = table.add(h, content)
                        homes.append((part, order))
                home.append(homes[entry][0] if entry >= 0 else None)
                home_ord.append(homes[entry][1] if entry >= 0 else None)
                left.append(content if entry < 0 else None)
            names = batch.schema.names
            arrays = list(batch.columns)
            arrays[names.index("home")] = pa.array(home, pa.int32())
            arrays[names.index("home_ord")] = pa.array(home_ord, pa.int64())
            arrays[names.index("content")] = pa.array(left, pa.binary())
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def bucket_count(n_bytes: int, table_bytes: int, width: int) -> int:
    """Buckets whose share of all contents fills half a table, a shuffle's width at least."""
    return max(width, -(-2 * n_bytes // table_bytes))


def exact_groups(
    docs: DataFrame,
    key: str = "doc_id",
    content: Column | None = None,
    row_id: Column | None = None,
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """Groups of rows with equal content.

    Returns one row per row of ``docs``: ``row_id`` (as given, else null),
    ``row_key`` (the key), ``keep_key`` (the largest key of the group),
    ``group_size`` long, ``kept`` boolean (true for exactly one row of each
    group), ``sha`` (SHA-256 of the content, lowercase hex).

    ``content`` defaults to the column ``text``; null counts as empty, so null
    and empty texts form one group.  Null keys lose against all others; a group
    of null keys only has a null ``keep_key``.  Of rows that repeat the winning
    key, one is kept.  An empty table gives no rows; other columns are not read.
    ``docs`` should come from storage or ``stage``, so that a task that runs
    again sees the same rows.

    Copies meet within each task first, so a content held by a third of all rows
    crosses the network once per task; the rows themselves travel without text
    and spread over all tasks.
    """
    spark = docs.sparkSession
    content = F.coalesce(content if content is not None else F.col("text"), F.lit(""))
    row_id = F.lit(None) if row_id is None else row_id
    records = docs.select(
        row_id.cast("long").alias("row_id"),
        F.col(key).cast("long").alias("row_key"),
        F.sha2(content, 256).alias("sha"),
        F.xxhash64(content).alias("h"),
        content.cast("binary").alias("content"),
    ).mapInArrow(_collapse(table_bytes), _SPILL)
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length(content) + ENTRY_BYTES), F.lit(0))).first()[0]
    placed = None
    for level in range(MAX_LEVELS):
        # Contents go to their bucket; rows without one have met an equal already
        # and go anywhere.
        place = F.when(
            F.col("content").isNotNull(), F.xxhash64("h", F.lit(level))
        ).otherwise(F.xxhash64("row_key", "nth", "part"))
        found = stage(
            records.withColumn("place", place)
            .repartition(bucket_count(n_bytes, table_bytes, shuffle_width(spark)), "place")
            .drop("place")
            .mapInArrow(_bucket(table_bytes), _SPILL),
            "grace",
        )
        done = found.filter("content is null").drop("content")
        placed = done if placed is None else placed.unionByName(done)
        records = found.filter("content is not null")
        left, n_bytes = records.agg(F.count(F.lit(1)), F.sum(F.octet_length("content") + ENTRY_BYTES)).first()
        if not left:
            break
    else:
        raise RuntimeError(f"buckets still overflow after {MAX_LEVELS} levels")
    link = ["part", "h", "ord"]
    home = ["home", "h", "home_ord"]
    members = placed.groupBy(*link).agg(
        F.max("row_key").alias("top"), F.count(F.lit(1)).alias("n")
    )
    firsts = placed.filter("home is not null").select(*link, "home", "home_ord")
    groups = (
        firsts.join(members, link)
        .groupBy(*home)
        .agg(
            F.max(F.struct("top", "part", "ord")).alias("best"),
            F.sum("n").alias("group_size"),
        )
    )
    here = (F.col("part") == F.col("best.part")) & (F.col("ord") == F.col("best.ord"))
    verdicts = firsts.join(groups, home).select(
        *link, F.col("best.top").alias("keep_key"), "group_size", here.alias("best_here")
    )
    wins = F.col("row_key").eqNullSafe(F.col("keep_key")) & (F.col("nth") == 0)
    return placed.join(verdicts, link).select(
        "row_id",
        "row_key",
        "keep_key",
        "group_size",
        (F.col("best_here") & wins).alias("kept"),
        "sha",
    )


def drop_exact_copies(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``docs`` with one row of each group of equal texts, that with the largest doc_id.

    All columns stay as they are; for nulls and repeated rows see ``exact_groups``.
    """
    columns = docs.columns
    docs, row = row_key(docs)
    groups = exact_groups(docs, row_id=F.col(row), table_bytes=table_bytes)
    kept = groups.filter("kept").select(F.col("row_id").alias(row))
    return docs.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in columns])
