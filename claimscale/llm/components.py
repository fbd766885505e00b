"""Connected components of links between whole numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscale.sources.staging import stage_few

LINKS_AT_ONCE = 1 << 18  # that a task turns into stars together


def least_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in the links u - v, ascending, and the smallest that each can reach."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place.ravel()[: len(u)], place.ravel()[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        moved = label.copy()
        for ends in (a, b, label[a], label[b]):
            np.minimum.at(moved, ends, least)
        moved = moved[moved]
        if np.array_equal(moved, label):
            return nodes, nodes[label]
        label = moved


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that reach the same, as stars: fewer, and mostly done where the links are few."""

    def star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        node, least = least_reachable(*(table.column(c).to_numpy() for c in ("u", "v")))
        out = node != least
        return pa.RecordBatch.from_arrays([pa.array(node[out]), pa.array(least[out])], names=["u", "v"])

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= LINKS_AT_ONCE:
            yield star(held)
            held, n = [], 0
    if n:
        yield star(held)


def stars(links: DataFrame) -> DataFrame:
    """The smallest number that each one can reach, without those that reach no smaller one.

    ``links`` has the columns u and v (long); direction, repeats and links to
    itself don't matter.  Returns node, component (written).

    Tasks first turn the links they have into stars.  Then large stars and small stars
    in turn (Kiveris and others, 2014): every step ties neighbours to the smallest one
    known, so the number of links never grows and any graph becomes stars in a number
    of steps that is logarithmic in practice.  Each step is written once; a node with
    very many links is an aggregate and one side of a join, both of which Spark can split.
    """
    links = links.select("u", "v").filter("u is not null and v is not null and u <> v")
    links = stage_few(links.distinct(), "links", _local_stars)
    while True:
        # Stars are done: no node hangs on two, and no centre on another one.
        twice = links.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"))
        centres = links.select(F.col("v").alias("u"))
        open_ends = twice.filter("low < high").select("u")
        if open_ends.unionByName(centres.join(links, "u", "left_semi")).isEmpty():
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least"))
        least = least.select("u", F.least("u", "least").alias("least"))
        large = both.join(least, "u").filter("v > u").select("v", "least").distinct()
        large = stage_few(large.select(F.col("v").alias("u"), F.col("least").alias("v")), "links")
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = small.unionByName(least.select("u", F.col("least").alias("v")))
        links = stage_few(small.filter("u <> v").distinct(), "links")
    return links.distinct().select(F.col("u").alias("node"), F.col("v").alias("component"))


def components(links: DataFrame) -> DataFrame:
    """``stars`` with those that reach no smaller number: node, component for every number in a link."""
    found = stars(links)
    centres = found.select(F.col("component").alias("node")).distinct()
    return found.unionByName(centres.select("node", F.col("node").alias("component")))
