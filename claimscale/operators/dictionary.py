"""The terms of a corpus: counted, numbered and put in the texts' place, all as tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscale.operators.compute import explode_computed
from claimscale.operators.ranking import rank_within
from claimscale.shipping import ship
from claimscale.sources.staging import stage

MOST_ROWS, MOST_TERMS = 50_000, 2_000_000  # of a chunk


def term_counts(tokens: DataFrame, column: str = "tokens") -> DataFrame:
    """Occurrences of each term; a frequent term is combined on the map side."""
    terms = explode_computed(tokens, F.col(column), [], "at", "term")
    return terms.groupBy("term").count()


def ranked_terms(
    tokens: DataFrame, column: str = "tokens", size: int | None = None
) -> DataFrame:
    """All terms, or the ``size`` most frequent ones, ties in alphabetical order.

    A total order makes the vocabulary, and with it the model, the same on every run.
    """
    order = [F.desc("count"), F.asc("term")]
    ranked = rank_within(term_counts(tokens, column), [], order)
    return ranked if size is None else ranked.filter(F.col("rank") <= size)


def dictionary(
    tokens: DataFrame,
    column: str = "tokens",
    size: int | None = None,
    bases: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """term_id (from 0, by rank), term, base, count, is_first.

    ``bases`` maps a table of distinct terms to (term, base), for example to stems; the
    forms of one base share its number and ``count`` is of all of them, and the first in
    alphabetical order is marked.  Without it each term is its own base.  No list of terms
    ever leaves the executors.
    """
    if bases is None:
        ranked = ranked_terms(tokens, column, size)
        return ranked.select(
            (F.col("rank") - 1).alias("term_id"),
            "term",
            F.col("term").alias("base"),
            "count",
            F.lit(True).alias("is_first"),
        )
    counts = stage(term_counts(tokens, column), "term-counts")
    mapped = stage(counts.join(bases(counts.select("term")), "term"), "bases")
    sums = mapped.groupBy("base").agg(F.sum("count").alias("count"), F.min("term").alias("_first"))
    ranked = rank_within(sums, [], [F.desc("count"), F.asc("base")])
    if size is not None:
        ranked = ranked.filter(F.col("rank") <= size)
    return mapped.drop("count").join(ranked, "base").select(
        (F.col("rank") - 1).alias("term_id"),
        "term",
        "base",
        "count",
        (F.col("term") == F.col("_first")).alias("is_first"),
    )


def by_chunks(rows: DataFrame, column: str, most_rows: int, most_terms: int) -> DataFrame:
    """Written ``rows`` (row: as Spark numbers them, the array ``column``) with their ``chunk``.

    A chunk is of rows that were written by one task, and holds some ``most_terms`` terms.
    """
    n, held = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(column)), F.lit(0))).first()
    size = max(1, min(most_rows, most_terms * n // max(held, 1)))
    task, at = F.shiftright("row", 33), F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("chunk", F.concat_ws("-", task, F.floor(at / size)))


def terms_of_chunks(rows: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
    """The rows of ``lookup`` (term and more) that each chunk needs, once a chunk: of, term, ...

    The rows of a chunk come from one task, so its distinct terms are found before they move.
    """
    terms = rows.select(F.col("chunk").alias("of"), F.explode(column).alias("term")).distinct()
    return terms.join(lookup, "term")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """held, terms, counts: the distinct terms of each row and how often they occur there."""
    for batch in batches:
        lists = batch.column("tokens")
        codes = lists.flatten().dictionary_encode()
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)
        found = codes.indices.is_valid().to_numpy(zero_copy_only=False)
        width = max(len(codes.dictionary), 1)
        pairs = row[found] * width + codes.indices.drop_null().to_numpy()
        pairs, counts = np.unique(pairs, return_counts=True)
        ends = np.searchsorted(pairs // width, np.arange(len(sizes) + 1)).astype(np.int32)
        kept = pa.array(np.flatnonzero(np.diff(ends)))
        terms = codes.dictionary.take(pa.array(pairs % width))
        columns = [
            batch.column("held"),
            pa.ListArray.from_arrays(pa.array(ends), terms),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(counts.astype(np.int64))),
        ]
        out = pa.RecordBatch.from_arrays(columns, names=["held", "terms", "counts"])
        yield out.take(kept)


def _bagged(rows: pa.Table, known: pa.Table) -> pa.Table:
    """held, bag: the rows of a chunk with known terms, by these terms' numbers."""
    terms, counts = (rows.column(c).combine_chunks() for c in ("terms", "counts"))
    sizes = pc.list_value_length(terms).to_numpy()
    # A term may have several numbers: those of a term stand together.
    names = known.column("term").combine_chunks().dictionary_encode()
    order = np.argsort(names.indices.to_numpy(), kind="stable")
    numbers = known.column("term_id").to_numpy()[order]
    each = np.bincount(names.indices.to_numpy(), minlength=len(names.dictionary))
    starts = np.cumsum(each) - each
    at = pc.index_in(terms.flatten(), value_set=names.dictionary)
    met = at.is_valid().to_numpy(zero_copy_only=False)
    at = at.drop_null().to_numpy().astype(np.int64)
    times = each[at]
    shift = np.repeat(starts[at] - (np.cumsum(times) - times), times)
    row = np.repeat(np.repeat(np.arange(len(sizes)), sizes)[met], times)
    ids = numbers[shift + np.arange(len(shift))]
    n = np.repeat(counts.flatten().to_numpy()[met], times)
    # Forms of one base are one term.
    order = np.lexsort((ids, row))
    row, ids, n = row[order], ids[order], n[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])
    first = np.flatnonzero(first)
    n = np.add.reduceat(n, first) if len(first) else n
    row, ids = row[first], ids[first]
    kept = np.unique(row)
    ends = np.append(np.searchsorted(row, kept), len(row)).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(ids), pa.array(n)], names=["term_id", "n"])
    bags = pa.ListArray.from_arrays(pa.array(ends), pairs)
    return pa.Table.from_arrays([rows.column("held").take(pa.array(kept)), bags], names=["held", "bag"])


def term_bags(
    tokens: DataFrame,
    known: DataFrame,
    keys: Sequence[str],
    column: str = "tokens",
    unique: bool = False,
) -> DataFrame:
    """Per text (``keys``) the array ``bag`` of (term_id, n), in order of the ids.

    Terms outside ``known`` (term_id, term) go, and texts without any known term too.
    Occurrences are combined row by row before anything moves; then chunks of rows meet
    the numbers of their own terms, each once a chunk.  Rows that repeat their keys are
    one text; where they do, bags move once more.  ``unique`` says that they don't.
    """
    ship(tokens.sparkSession)
    keys = list(keys)
    held = F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]).alias("held")
    rows = tokens.select(held, F.col(column).alias("tokens"))
    kind = T.StructType(
        [
            rows.schema["held"],
            T.StructField("terms", T.ArrayType(T.StringType())),
            T.StructField("counts", T.ArrayType(T.LongType())),
        ]
    )
    rows = rows.mapInArrow(_counted, kind).withColumn("row", F.monotonically_increasing_id())
    rows = by_chunks(stage(rows, "counted"), "terms", MOST_ROWS, MOST_TERMS)
    numbers = known.select("term", F.col("term_id").cast("long").alias("term_id"))
    met = rows.groupBy("chunk").cogroup(terms_of_chunks(rows, "terms", numbers).groupBy("of"))
    pair = T.StructType([T.StructField("term_id", T.LongType()), T.StructField("n", T.LongType())])
    kind = T.StructType([kind["held"], T.StructField("bag", T.ArrayType(pair))])
    bags = met.applyInArrow(lambda left, right: _bagged(left, right), kind)
    bags = bags.select(*[F.col(f"held.k{i}").alias(k) for i, k in enumerate(keys)], "bag")
    if unique or not _repeats(rows, "held"):
        return bags
    summed = bags.select(*keys, F.inline("bag")).groupBy(*keys, "term_id").agg(F.sum("n").alias("n"))
    pairs = F.collect_list(F.struct("term_id", "n"))
    return summed.groupBy(*keys).agg(F.array_sort(pairs).alias("bag"))


def _repeats(rows: DataFrame, column: str) -> bool:
    n, distinct = rows.agg(F.count(F.lit(1)), F.count_distinct(column)).first()
    return n > distinct
