"""Mixing sources to target weights by weighted sampling without replacement.

Every document draws the key -ln(u) / weight (Efraimidis and Spirakis): in
ascending order of the keys a source is a weighted random order, and the prefix
that fills a budget is a weighted sample.  A source whose target exceeds its size
gives whole epochs first; only what remains is selected by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscale.llm.rows import free_name, row_key
from claimscale.sources.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = [5.0, 2.0, 1.0]
MAX_EPOCHS = 3
SEED = 7
ROWS_PER_BUCKET = 4_000
PLAIN_SIGNS = "0123456789{}[]()<>|\\/=+*#_$%&@~^\"`"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def plain_share(text: Column) -> Column:
    """Default quality weight: 0.1 to 1, the share of signs that prose is made of, squared."""
    length = F.length(text)
    share = F.length(F.translate(text, PLAIN_SIGNS, "")) / F.nullif(length, F.lit(0))
    return F.greatest(F.coalesce(share * share, F.lit(0.1)), F.lit(0.1))


def key_columns(weight: Column | None = None, seed: int = SEED) -> list[Column]:
    """What the mix has to know of a document: doc_id, source, size, key, tie.

    A weight that is null or not positive counts as 1e-6.  Rows that agree in
    doc_id and text draw the same key.
    """
    weight = weight if weight is not None else plain_share(F.col("text"))
    weight = F.greatest(F.coalesce(weight.cast("double"), F.lit(1e-6)), F.lit(1e-6))
    tie = F.xxhash64("doc_id", "text")
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", tie), 11).cast("double")
    u = (draw + 0.5) * F.lit(2.0**-53)
    return [
        F.col("doc_id"),
        F.col("source"),
        word_count(F.col("text")).alias("size"),
        (-F.log(u) / weight).alias("key"),
        tie.alias("tie"),
    ]


def source_targets(
    narrow: DataFrame, weights: list[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """One row per source: source, source_size, target.

    Sources in code-point order, null last, take the weights in turn.  The
    targets share the sum of all sizes by weight; a target stops at
    ``max_epochs`` times its source's size and the excess is shared again.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)),
        ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"),
    )
    sources = stage(
        narrow.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .select("source", "source_size", turn.alias("weight")),
        "sources",
    )
    cap = F.col("source_size") * max_epochs
    total, heft = sources.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))
    ).first()
    level, past = (total / heft if heft else 0.0), -1.0
    # Capping a source raises the level, which may cap others; it never falls.
    while level > past:
        past = level
        full = F.col("weight") * past >= cap
        capped, rest = sources.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        level = (total - capped) / rest if rest else past
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(max(level, past)))
    return sources.select("source", "source_size", target.alias("target"))


def selection(narrow: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source what decides about each of its documents.

    Returns source, source_size, target, epochs, and of the document at the
    border border_key, border_tie, border_words (null when only epochs are taken).
    """
    per_bucket = narrow.count() // ROWS_PER_BUCKET + 1
    bucket = F.floor((1 - F.exp(-F.col("key"))) * per_bucket)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    plan = targets.withColumn("epochs", F.coalesce(epochs, F.lit(0)).cast("long")).withColumn(
        "budget",
        (F.floor(F.col("target")) - F.col("epochs") * F.col("source_size")).cast("long"),
    )
    # Copies of one row share their key: together they are one entry.
    entries = (
        narrow.filter("size > 0")
        .groupBy("source", "key", "tie", "size")
        .agg(F.count(F.lit(1)).alias("copies"), F.sum("size").alias("words"))
        .withColumn("bucket", bucket)
    )
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = (
        entries.groupBy("source", "bucket")
        .agg(F.sum("words").alias("words"))
        .withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    )
    same = sums["source"].eqNullSafe(plan["source"])
    at = (
        sums.join(plan.select("source", "budget"), same)
        .filter("before < budget and budget <= before + words")
        .select(
            sums["source"].alias("s"), F.col("bucket").alias("b"), "before", "budget"
        )
    )
    within = Window.partitionBy("source").orderBy("key", "tie").rowsBetween(
        Window.unboundedPreceding, -1
    )
    border = (
        entries.join(at, entries["source"].eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .withColumn("before", F.col("before") + F.coalesce(F.sum("words").over(within), F.lit(0)))
        .filter("before < budget and budget <= before + words")
        .select(
            F.col("source").alias("s"),
            F.col("key").alias("border_key"),
            F.col("tie").alias("border_tie"),
            # Every copy of the border document gives the same number of words.
            F.expr("(budget - before) div copies").alias("border_words"),
        )
    )
    return plan.join(border, plan["source"].eqNullSafe(border["s"]), "left").select(
        *plan.columns[:-1], "border_key", "border_tie", "border_words"
    )


def _with_selection(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """``rows`` (with source, size, key, tie) joined with their source's decision."""
    chosen = chosen.withColumnRenamed("source", "of_source")
    below = F.struct("key", "tie") < F.struct("border_key", "border_tie")
    at = (F.col("key") == F.col("border_key")) & (F.col("tie") == F.col("border_tie"))
    extra = (
        F.when(F.col("border_key").isNull(), 0)
        .when(below, F.col("size"))
        .when(at, F.col("border_words"))
        .otherwise(0)
    )
    return (
        rows.join(chosen, rows["source"].eqNullSafe(F.col("of_source")))
        .withColumn("extra", extra.cast("long"))
        .withColumn("taken", F.col("epochs") * F.col("size") + F.col("extra"))
    )


def mix_counts(
    docs: DataFrame,
    weights: list[float] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    weight: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """How many words of each document the mix takes.

    Returns one row per row of ``docs``: doc_id, source, size, source_size,
    target, epochs, extra (words beyond the epochs), taken.  Null and empty texts
    have size 0 and give nothing; a null source is a source, the last; rows that
    repeat a document are taken alike; an empty table gives no rows.  The border
    document of a source gives its first words only, so that a source misses its
    target by less than a word (and by less than a word per repeated row).

    Only (source, size, key) is shuffled.  Keys fall into fine buckets whose sums
    find the border, so no source is sorted in one task, however hot.
    """
    narrow = stage(docs.select(*key_columns(weight, seed)), "mix")
    chosen = stage(selection(narrow, source_targets(narrow, weights, max_epochs)), "mix")
    return _with_selection(narrow, chosen).select(
        "doc_id", "source", "size", "source_size", "target", "epochs", "extra", "taken"
    )


def mix(
    docs: DataFrame,
    weights: list[float] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    weight: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """The mixed corpus: rows of ``docs``, repeated as often as they are taken.

    All columns stay; the border document of each source comes once more with its
    first words as its text.  See ``mix_counts`` for nulls and repeated rows.
    """
    columns = docs.columns
    docs, row = row_key(docs)
    number = free_name(docs, "row_number")
    narrow = docs.select(F.col(row).alias(number), *key_columns(weight, seed))
    narrow = stage(narrow, "mix")
    chosen = stage(selection(narrow, source_targets(narrow, weights, max_epochs)), "mix")
    decided = _with_selection(narrow, chosen).filter("taken > 0")
    whole = F.col("epochs") + F.when(F.col("extra") == F.col("size"), 1).otherwise(0)
    part = F.when((F.col("extra") > 0) & (F.col("extra") < F.col("size")), F.col("extra"))
    words = free_name(docs, "first_words")
    copies = F.concat(
        F.array_repeat(F.lit(None).cast("long"), whole.cast("int")),
        F.when(part.isNotNull(), F.array(part)).otherwise(F.array().cast("array<long>")),
    )
    decided = decided.select(F.col(number).alias(row), F.explode(copies).alias(words))
    taken = docs.join(decided, row)
    found = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    first = F.array_join(F.slice(found, F.lit(1), F.col(words).cast("int")), " ")
    text = F.when(F.col(words).isNull(), F.col("text")).otherwise(first)
    return taken.withColumn("text", text).select(*[F.col(f"`{c}`") for c in columns])
