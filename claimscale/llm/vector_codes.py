"""Vector code compression: product quantization with whole numbers and exact bounds.

Each part of a vector is coded by the nearest entry of its codebook, and the codebooks
are refined in rounds.  A vector part remembers, for each group of entries, how near
one of them was at best, and in which round that was found out.  The codebooks of all
rounds are kept, so a bound is weakened by the net way that entries have gone since its
stamp (the norm of the sum of their steps), which is less than the steps added up.
Only groups whose bound doesn't rule them out are compared anew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscale.operators.joins import lookup_join
from claimscale.sources.staging import fresh_path

PARTS, ENTRIES, ROUNDS, GROUPS = 4, 256, 4, 16
SCALE = 1024
MOST = 1 << 28  # of a component; squares of differences stay within 64 bits
ROWS = 4096  # compared at once
UP, DOWN = 1 + 1e-9, 1 - 1e-9

_SUMS = "part int, entry int, n long, sums array<long>"


class Codes(NamedTuple):
    """vec_id, label, code, error of every kept vector; and the final codebooks."""

    rows: DataFrame
    codebooks: np.ndarray  # parts x entries x components


class Bounds(NamedTuple):
    """What rows know of one part: their entry, and per group a distance and its round."""

    entry: np.ndarray
    least: np.ndarray
    stamp: np.ndarray


def squared_distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """All squared distances as whole numbers, exactly."""
    width = max(rows.shape[1], 1)
    most = max(abs(rows).max(initial=0), abs(entries).max(initial=0))
    if 4 * width * int(most) ** 2 < 1 << 53:  # floats are exact up to there
        x, c = rows.astype(np.float64), entries.astype(np.float64)
        found = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
        return found.astype(np.int64)
    found = np.zeros((len(rows), len(entries)), np.int64)
    for i in range(rows.shape[1]):
        found += np.square(rows[:, i, None] - entries[None, :, i])
    return found


def entry_groups(codebook: np.ndarray, groups: int) -> list[np.ndarray]:
    """Entries by the nearest of some that lie far apart; any grouping gives right codes."""
    far = [0]
    away = squared_distances(codebook, codebook[:1])[:, 0]
    while len(far) < groups and away.max() > 0:
        far.append(int(away.argmax()))
        away = np.minimum(away, squared_distances(codebook, codebook[far[-1:]])[:, 0])
    near = squared_distances(codebook, codebook[far]).argmin(1)
    return [np.flatnonzero(near == g) for g in range(len(far))]


def net_ways(history: list[np.ndarray], groups: list[np.ndarray]) -> np.ndarray:
    """Per round and group, how far an entry of it has got since then at most."""
    now = history[-1].astype(np.float64)
    ways = [np.sqrt(((now - then) ** 2).sum(1)) * UP for then in history]
    return np.array([[way[g].max() for g in groups] for way in ways])


def first_bounds(rows: int, groups: int) -> Bounds:
    """Nothing is known yet: every group has to be looked at."""
    least = np.full((rows, groups), -np.inf, np.float32)
    return Bounds(np.zeros(rows, np.uint8), least, np.zeros((rows, groups), np.uint8))


def assign(
    rows: np.ndarray, history: list[np.ndarray], groups: list[np.ndarray], known: Bounds
) -> tuple[Bounds, np.ndarray, int]:
    """The nearest entry of the newest codebook for one part of some rows.

    Returns new bounds, squared distances, and how many distances were worked out.
    """
    now, book = len(history) - 1, history[-1]
    old = known.entry.astype(np.int64)
    moved = rows - book[old]
    own = np.square(moved).sum(1)
    best, nearest = own.copy(), old.copy()
    ways = net_ways(history, groups)
    held = known.least - np.take_along_axis(ways, known.stamp.astype(np.int64), 0)
    open_ = held * DOWN <= np.sqrt(own.astype(np.float64))[:, None] * UP
    compared, worked = {}, len(rows)
    for g, members in enumerate(groups):
        at = np.flatnonzero(open_[:, g])
        if not len(at):
            continue
        found = squared_distances(rows[at], book[members])
        compared[g] = at, found
        worked += found.size
        pick = found.argmin(1)
        near, which = found[np.arange(len(at)), pick], members[pick]
        better = (near < best[at]) | ((near == best[at]) & (which < nearest[at]))
        best[at[better]], nearest[at[better]] = near[better], which[better]
    least, stamp = known.least.copy(), known.stamp.copy()
    group_of = np.empty(len(book), np.int64)
    for g, members in enumerate(groups):
        group_of[members] = g
    # An entry that is left counts for its group again, if that wasn't looked at.
    left = np.flatnonzero(nearest != old)
    left = left[~open_[left, group_of[old[left]]]]
    its = group_of[old[left]]
    least[left, its] = _below(np.minimum(held[left, its], np.sqrt(own[left].astype(np.float64))))
    stamp[left, its] = now
    for g, (at, found) in compared.items():
        others = found.astype(np.float64)
        others[groups[g][None, :] == nearest[at][:, None]] = np.inf
        least[at, g], stamp[at, g] = _below(np.sqrt(others.min(1))), now
    return Bounds(nearest.astype(np.uint8), least, stamp), best, worked


def _below(values: np.ndarray) -> np.ndarray:
    """As short floats that are not larger."""
    return np.nextafter((values * DOWN).astype(np.float32), np.float32(-np.inf))


def _packed(values: np.ndarray) -> pa.Array:
    """One blob per row."""
    flat = np.ascontiguousarray(values).reshape(len(values), -1)
    width = flat.shape[1] * flat.itemsize
    fixed = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(flat), [None, pa.py_buffer(flat.tobytes())]
    )
    return fixed.cast(pa.binary())


def _unpacked(column: pa.Array, kind: type, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape).copy()


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _assigned(history: list[np.ndarray], groups: list[list[np.ndarray]], last: bool):
    """Rows with new entries and bounds, then the sums of this task's parts by entry."""
    parts, entries, size = history[0].shape
    books = [[book[p] for book in history] for p in range(parts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, size), np.int64)
        counts = np.zeros((parts, entries), np.int64)
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                n = batch.num_rows
                vectors = _matrix(batch.column("components"), parts * size).reshape(n, parts, size)
                counted = [len(g) for g in groups]
                if len(history) == 1:
                    known = [first_bounds(n, k) for k in counted]
                else:
                    entry = _unpacked(batch.column("entries"), np.uint8, (parts,))
                    cut = np.cumsum([0, *counted])
                    least = _unpacked(batch.column("least"), np.float32, (cut[-1],))
                    stamp = _unpacked(batch.column("stamps"), np.uint8, (cut[-1],))
                    known = [
                        Bounds(entry[:, p], least[:, a:b], stamp[:, a:b])
                        for p, (a, b) in enumerate(zip(cut, cut[1:]))
                    ]
                found = [assign(vectors[:, p], books[p], groups[p], known[p]) for p in range(parts)]
                entry = np.stack([bounds.entry for bounds, _, _ in found], 1)
                if last:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("vec_id"),
                            batch.column("label"),
                            _packed(entry),
                            pa.array(sum(best for _, best, _ in found)),
                        ],
                        names=["vec_id", "label", "entries", "error"],
                    )
                    continue
                for p in range(parts):
                    np.add.at(sums[p], entry[:, p], vectors[:, p])
                    counts[p] += np.bincount(entry[:, p], minlength=entries)
                nothing = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id"),
                        batch.column("label"),
                        batch.column("components"),
                        _packed(entry),
                        _packed(np.concatenate([b.least for b, _, _ in found], 1)),
                        _packed(np.concatenate([b.stamp for b, _, _ in found], 1)),
                        *nothing,
                    ],
                    names=["vec_id", "label", "components", "entries", "least", "stamps",
                           "part", "entry", "n", "sums"],
                )
        if not last and counts.any():
            part, entry = np.nonzero(counts)
            columns = [pa.nulls(len(part), batch.column(c).type) for c in ("vec_id", "label", "components")]
            columns += [pa.nulls(len(part), pa.binary())] * 3
            columns += [
                pa.array(part, pa.int32()),
                pa.array(entry, pa.int32()),
                pa.array(counts[part, entry]),
                pa.array(sums[part, entry].tolist(), pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(
                columns,
                names=["vec_id", "label", "components", "entries", "least", "stamps",
                       "part", "entry", "n", "sums"],
            )

    return run


def _emptied(df: DataFrame, path: str) -> None:
    """Free the files of a written table that is read no more."""
    df.sparkSession.createDataFrame([], df.schema).coalesce(1).write.mode("overwrite").parquet(path)


def whole_components(vectors: DataFrame) -> DataFrame:
    """vec_id, label, components: floor(SCALE * x) of the vectors that are numbers throughout."""
    value = F.col("embedding")
    number = F.forall(
        value,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    far = F.exists(value, lambda x: F.abs(x.cast("double")) * SCALE >= MOST)
    scaled = F.transform(value, lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    checked = F.when(far, F.raise_error(F.lit(f"a component of {MOST // SCALE} or more"))).otherwise(scaled)
    kept = vectors.filter(value.isNotNull()).filter(number)
    return kept.select("vec_id", "label", checked.alias("components"))


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    groups: int = GROUPS,
) -> Codes:
    """Code the vectors of ``vectors`` (vec_id, embedding, label) part by part.

    Vectors that are null or hold null or non-finite values are left out.  The others
    must have one length, a multiple of ``parts``, and values below 2 ** 18, else it is
    an error.  A codebook starts as the parts of the ``entries`` smallest vec_ids (nulls
    last, repeats by their components; fewer vectors, fewer entries), at most 256.
    Entries and distances are whole numbers and ties go to the lower entry, so the codes
    depend on nothing else.  Repeated rows are coded each and count each; an empty table
    gives no rows; other columns are not read, whatever their names.

    Every round writes one table of the rows with their bounds to the shared folder and
    empties the one before.  A task adds up its parts by entry, so a vector that a third
    of all rows hold costs no more than others; what reaches the driver are the sums of
    all entries, as large as the codebooks.
    """
    if not 1 <= entries <= 256 or parts < 1 or rounds < 0:
        raise ValueError("1 to 256 entries, at least one part, no negative rounds")
    spark = vectors.sparkSession
    path = fresh_path(spark, "vectors")
    prepared = whole_components(vectors)
    prepared.write.parquet(path)
    table = spark.read.schema(prepared.schema).parquet(path)
    size = F.size("components")
    least, most = table.agg(F.min(size), F.max(size)).first()
    if least is None:
        return Codes(_coded(table.withColumns({"entries": F.lit(b""), "error": F.lit(0)})),
                     np.zeros((parts, 0, 0), np.int64))
    if least != most or least % parts or not least:
        raise ValueError(f"vectors of {least} to {most} values do not fall into {parts} equal parts")
    order = [F.col("vec_id").asc_nulls_last(), "components"]
    start = table.select("vec_id", "components").orderBy(*order).limit(entries).collect()
    book = np.array([row["components"] for row in start], np.int64)
    book = np.ascontiguousarray(book.reshape(len(start), parts, -1).transpose(1, 0, 2))
    history, grouped = [book], [entry_groups(book[p], groups) for p in range(parts)]
    state = f"{_types(prepared)}, entries binary, least binary, stamps binary, {_SUMS}"
    for _ in range(rounds):
        after = fresh_path(spark, "vectors")
        table.mapInArrow(_assigned(history, grouped, False), state).write.parquet(after)
        _emptied(table, path)
        path, written = after, spark.read.schema(state).parquet(after)
        history.append(_moved(history[-1], written))
        table = written.filter(F.col("part").isNull()).drop("part", "entry", "n", "sums")
    schema = f"{_types(prepared.drop('components'))}, entries binary, error long"
    coded = table.mapInArrow(_assigned(history, grouped, True), schema)
    return Codes(_coded(coded), history[-1])


def _types(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def _coded(rows: DataFrame) -> DataFrame:
    return rows.select("vec_id", "label", F.lower(F.hex("entries")).alias("code"), "error")


def _moved(book: np.ndarray, written: DataFrame) -> np.ndarray:
    """The codebooks with each entry at the mean of its parts, rounded down."""
    positions = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(book.shape[2])]
    sums = written.filter(F.col("part").isNotNull()).groupBy("part", "entry")
    moved = book.copy()
    for part, entry, n, *values in sums.agg(F.sum("n"), *positions).collect():
        moved[part, entry] = [v // n for v in values]
    return moved


def codebook_digest(codebooks: np.ndarray) -> str:
    """sha256 of all components as decimal numbers, by part, entry and position."""
    text = ",".join(map(str, codebooks.ravel().tolist()))
    return hashlib.sha256(text.encode()).hexdigest()


def with_label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` with label_error: the errors of all rows of the same label, nulls together."""
    keys = {
        "_label": F.coalesce(F.col("label").cast("string"), F.lit("")),
        "_none": F.col("label").isNull(),
    }
    keyed = rows.withColumns(keys)
    sums = keyed.groupBy(*keys).agg(F.sum("error").alias("label_error"))
    return lookup_join(keyed, sums, list(keys)).drop(*keys)
