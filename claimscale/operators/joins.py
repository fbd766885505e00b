"""Lookup joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscale.session import shuffle_width
from claimscale.sources.staging import stage

BROADCAST_BYTES = 32 * 1024 * 1024
HEAVY_SHARE = 0.001
SAMPLE = 0.02
VALUE_BYTES = 16  # of any value in a row, null or not; texts come on top


def held_bytes(df: DataFrame) -> int:
    """About what the rows take in memory: one aggregate, one row to the driver.

    Every column has its fixed width whether it is null or not; strings, binaries
    and nested values add their lengths.
    """
    width = F.lit(VALUE_BYTES * len(df.columns))
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = F.to_json(F.struct(value.alias("v")))
            width = width + F.coalesce(F.octet_length(text), F.lit(0))
    sizes = df.select(width.cast("long").alias("n"))
    return sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]


def measured(lookup: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A lookup side to broadcast if it is small; for joins that ``lookup_join`` doesn't make."""
    return F.broadcast(lookup) if held_bytes(lookup) <= max_bytes else lookup


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner equi-join of a large side with a lookup side.

    The lookup side is broadcast only after its size was measured.  Beyond
    ``max_bytes`` both sides are shuffled, heavy keys split over many tasks.  A
    stream cannot be measured for heavy keys: it then takes a plain join, so a stream
    with a large lookup side is better joined batch by batch
    (``streaming.ingest.drain_joined``).
    """
    on = list(on)
    if held_bytes(lookup) <= max_bytes:
        return facts.join(F.broadcast(lookup), on)
    if facts.isStreaming:
        return facts.join(lookup, on)
    return split_join(facts, lookup, on, fraction=SAMPLE)


def heavy_keys(
    df: DataFrame,
    on: Sequence[str],
    share: float = HEAVY_SHARE,
    fraction: float = 1.0,
) -> DataFrame:
    """Keys with more than ``share`` of all rows, and their share; at most 1/share of them.

    They may be judged by a ``fraction`` of the rows.
    """
    seen = df.select(*on)
    if fraction < 1:
        seen = seen.sample(fraction, seed=1)
    rows = seen.select(F.count(F.lit(1)).alias("n")).scalar()
    counts = seen.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    found = counts.filter(F.col("_rows") > rows * share)
    return found.select(*on, (F.col("_rows") / rows).alias("_share"))


def split_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    share: float = HEAVY_SHARE,
    fraction: float = 1.0,
    staged: bool = False,
) -> DataFrame:
    """Inner equi-join in which the rows of each heavy key go to many tasks.

    A key gets as many of the shuffle's partitions as its share of the rows asks for
    (two at least), so a key with a third of all rows fills a third of the tasks.
    Only lookup rows of heavy keys are replicated.  The salt comes from the place of a
    row in its task, so rows that are equal in all columns spread too.  A task that runs
    again, because its executor was lost, has to give its rows the same salts: so the
    facts are written first and read from there, unless they are ``staged``, that is
    read from files with nothing but projections, filters and explodes in between.
    Which keys count as heavy changes only who does the work, never the result: a
    ``fraction`` of the rows can decide.  The decision is staged, because both sides
    have to follow the same one.
    """
    on = list(on)
    if not staged:
        facts = stage(facts, "facts")
    width = shuffle_width(facts.sparkSession)
    salts = F.greatest(F.ceil(F.col("_share") * width), F.lit(2)).cast("int")
    # Bounded by 1/share rows, whatever the size of the facts.
    chosen = heavy_keys(facts, on, share, fraction).select(*on, salts.alias("_salts"))
    chosen = stage(chosen, "heavy-keys")
    if chosen.isEmpty():
        return facts.join(lookup, on)
    heavy = F.broadcast(chosen)
    row = F.xxhash64(F.monotonically_increasing_id())
    hot = F.col("_salts").isNotNull()
    own = F.when(hot, F.pmod(F.col("_row"), F.col("_salts"))).otherwise(F.lit(0))
    salted = facts.withColumn("_row", row).join(heavy, on, "left")
    salted = salted.withColumn("_salt", own.cast("int")).drop("_row", "_salts")
    each = F.when(hot, F.sequence(F.lit(0), F.col("_salts") - 1)).otherwise(F.array(F.lit(0)))
    copies = lookup.join(heavy, on, "left").withColumn("_salt", F.explode(each))
    return salted.join(copies.drop("_salts"), [*on, "_salt"]).drop("_salt")
