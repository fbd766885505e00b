"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes ratios.

Each n-gram is worth the logarithm of how much more often toxic documents hold it
than clean ones; a logistic regression then weighs the n-grams so scaled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscale.llm import tokens
from claimscale.llm.arrow_text import chunks, lower_ascii
from claimscale.llm.spans import buffers
from claimscale.sources.staging import stage

SIZES = (4, 5, 6)  # bytes of UTF-8
FEATURE_BITS = 20
LEAST_DOCUMENTS = 3
LEAST_DEVIATIONS = 5.0
SAMPLE_TOXIC = 3_000
SAMPLE_CLEAN = 5_000
SAMPLE_PARTITIONS = 8
STEPS = 80
RATE = 0.5
RIDGE = 1e-3
THRESHOLD = 0.3
BLOCK_HITS = 1 << 18  # n-grams of training rows that the driver weighs at once
CHUNK_BYTES = 256 << 10  # of text at once; the arrays of all n-grams are some 60 times that


@dataclass
class Model:
    """Kept features in ascending order, their weights, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def _hashed(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: which text an n-gram is of, and its hashed feature.

    Texts are lower-cased in A-Z and set between blanks, so n-grams at their ends
    look like those at the ends of words; no n-gram reaches across texts.
    """
    n = len(offsets) - 1
    framed = np.full(len(data) + 2 * n + 8, 0x20, np.uint8)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    framed[np.arange(len(data)) + 2 * owner + 1] = lower_ascii(data)
    begins = offsets + 2 * np.arange(n + 1)
    owner = np.repeat(np.arange(n), np.diff(begins))
    loads = np.ndarray((begins[-1],), np.dtype("<u8"), framed.tobytes(), 0, (1,))
    for size in SIZES:
        inside = np.arange(begins[-1]) + size <= begins[1:][owner]
        grams = loads[inside] & np.uint64((1 << 8 * size) - 1)
        grams = grams * np.uint64(0x9E3779B97F4A7C15 + 2 * size)
        yield owner[inside], (grams >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens.forget()  # workers serve one step after the other
    held = np.zeros(1 << FEATURE_BITS, bool)
    for rows, data, offsets in chunks(batches, limit=CHUNK_BYTES):
        hashed = list(_hashed(data, offsets))
        edges = [np.searchsorted(owner, np.arange(rows.num_rows + 1)) for owner, _ in hashed]
        blobs = []
        for i in range(rows.num_rows):
            for (_, feature), edge in zip(hashed, edges):
                held[feature[edge[i] : edge[i + 1]]] = True
            found = np.flatnonzero(held)
            held[found] = False
            blobs.append(found.astype("<i4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [rows.column("toxic"), pa.array(blobs, pa.binary())], names=["toxic", "features"]
        )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per partition, how many toxic and clean documents hold each feature."""
    held, n = np.zeros((2, 1 << FEATURE_BITS), np.int32), [0, 0]
    for batch in batches:
        both = (batch.column(c).to_pylist() for c in ("toxic", "features"))
        for toxic, blob in zip(*both):
            held[toxic][np.frombuffer(blob, "<i4")] += 1
            n[toxic] += 1
    if sum(n):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([n[0]], pa.int64()),
                pa.array([n[1]], pa.int64()),
                pa.array([held.astype("<i4").tobytes()], pa.binary()),
            ],
            names=["clean", "toxic", "held"],
        )


def _only(kept: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flag = np.zeros(1 << FEATURE_BITS, bool)
        flag[kept] = True
        for batch in batches:
            blobs = [np.frombuffer(b, "<i4") for b in batch.column("features").to_pylist()]
            blobs = pa.array([b[flag[b]].tobytes() for b in blobs], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), blobs], names=["toxic", "features"])

    return run


def known_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and toxic (0 or 1) of every document that may be learned from, once each."""
    told = (
        labels.filter("doc_id is not null and toxic in (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    return told.join(known, "doc_id", "left_semi")


def _sampled(docs: DataFrame, told: DataFrame, toxic: int, clean: int) -> DataFrame:
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = told.filter("toxic = 1").orderBy(*order).limit(toxic)
    chosen = chosen.unionByName(told.filter("toxic = 0").orderBy(*order).limit(clean))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # At most toxic + clean pairs of numbers.
    return texts.join(F.broadcast(chosen), "doc_id").select("toxic", "text")


def training_sample(
    docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN
) -> DataFrame:
    """At most so many labelled documents of each kind, chosen by a hash of doc_id."""
    return _sampled(docs, known_labels(docs, labels), toxic, clean)


def fit(
    docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN
) -> Model:
    """Learn from labelled documents: ``labels`` has doc_id and toxic (0 or 1).

    At most ``toxic`` and ``clean`` documents are read; that bounds what reaches the
    driver.  All labelled documents are counted, and each row of the sample stands for
    as many as its kind has for one that was read: the bounds don't change the share of
    toxic documents that scores go by.  A document with several labels is toxic if one
    says so; null labels and labels of unknown documents don't count; null texts are
    empty.  Without any labels of one kind the model gives every text the share of toxic
    labels (one half without labels).
    """
    told = stage(known_labels(docs, labels), "toxic-labels")
    n_told = {row["toxic"]: row["count"] for row in told.groupBy("toxic").count().collect()}
    all_clean, all_toxic = n_told.get(0, 0), n_told.get(1, 0)
    if not all_clean or not all_toxic:
        share = (all_toxic + 1) / (all_clean + all_toxic + 2)
        none = np.zeros(0, np.int64)
        return Model(none, none.astype(float), float(np.log(share / (1 - share))))
    stands_for = np.array([max(all_clean / clean, 1.0), max(all_toxic / toxic, 1.0)])
    sample = stage(
        _sampled(docs, told, toxic, clean)
        .repartition(SAMPLE_PARTITIONS)
        .mapInArrow(_features, "toxic int, features binary"),
        "toxic-sample",
    )
    held, n_clean, n_toxic = np.zeros((2, 1 << FEATURE_BITS)), 0, 0
    for row in sample.mapInArrow(_counts, "clean long, toxic long, held binary").toLocalIterator():
        held += np.frombuffer(row["held"], "<i4").reshape(2, -1)
        n_clean, n_toxic = n_clean + row["clean"], n_toxic + row["toxic"]
    ratio = np.log((held[1] + 1) / (n_toxic + 2)) - np.log((held[0] + 1) / (n_clean + 2))
    # Only n-grams that toxic documents hold far more often than chance would have it.
    share = stands_for @ held / (stands_for @ [n_clean, n_toxic])
    deviation = np.sqrt(n_toxic * share * (1 - share)) + 1e-9
    far = held[1] - n_toxic * share > LEAST_DEVIATIONS * deviation
    kept = np.flatnonzero(far & (held[1] >= LEAST_DOCUMENTS))
    if not len(kept):
        kept = np.flatnonzero(held[1])
    rows = sample.mapInArrow(_only(kept), "toxic int, features binary").toArrow()
    data, edges = buffers(rows.column("features").combine_chunks())
    truth = np.array(rows.column("toxic").to_pylist(), np.int64)
    place = np.zeros(1 << FEATURE_BITS, np.int32)
    place[kept] = np.arange(len(kept))
    column = place[data[edges[0] : edges[-1]].view("<i4")]
    edges = (edges - edges[0]) // 4
    del rows, data, sample, held
    pa.default_memory_pool().release_unused()
    weights, bias = _regress(edges, column, ratio[kept], truth, stands_for[truth])
    return Model(kept, weights * ratio[kept], bias)


def _scale(hits: np.ndarray) -> np.ndarray:
    """Long texts hold more n-grams; this keeps their scores comparable."""
    return 1 / np.sqrt(np.maximum(hits, 1))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _blocks(edges: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows together that hold some BLOCK_HITS n-grams, or one row that holds more."""
    first = 0
    while first + 1 < len(edges):
        last = int(np.searchsorted(edges, edges[first] + BLOCK_HITS, side="right")) - 1
        yield first, (last := max(last, first + 1))
        first = last


def _regress(
    edges: np.ndarray,
    column: np.ndarray,
    ratio: np.ndarray,
    truth: np.ndarray,
    stands_for: np.ndarray,
) -> tuple[np.ndarray, float]:
    """Logistic regression by full gradient steps, each coordinate at its own pace.

    Row i holds the n-grams ``column[edges[i] : edges[i + 1]]`` and counts as the number
    of rows it stands for.  A step goes through blocks of rows in order, so beside
    ``column`` the driver holds the numbers of one block only.
    """
    n, sizes = len(truth), np.diff(edges)
    scale = _scale(sizes)
    part = stands_for / stands_for.mean()
    weights, bias = np.zeros(len(ratio)), 0.0
    past, past_bias = np.full(len(ratio), 1e-8), 1e-8
    for _ in range(STEPS):
        error, gradient = np.zeros(n), np.zeros(len(ratio))
        for a, b in _blocks(edges):
            own, hit = np.repeat(np.arange(b - a), sizes[a:b]), column[edges[a] : edges[b]].astype(np.intp)
            value = ratio[hit] * scale[a:b][own]
            z = np.bincount(own, value * weights[hit], b - a) + bias
            error[a:b] = (_sigmoid(z) - truth[a:b]) * part[a:b]
            np.add.at(gradient, hit, value * error[a:b][own])
        gradient = gradient / n + RIDGE * weights
        past += gradient**2
        weights -= RATE * gradient / np.sqrt(past)
        past_bias += error.mean() ** 2
        bias -= RATE * error.mean() / np.sqrt(past_bias)
    return weights, float(bias)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` (with a column text) and a score from 0 to 1, higher: likelier toxic.

    Nothing but the whole text decides.  Null and empty texts get the score that
    the bias alone gives.  Rows and other columns stay as they are, a column of the
    score's name is replaced; an empty table stays empty.  The model is at most
    2 ** FEATURE_BITS weights and travels with the tasks.
    """
    docs = docs.drop(column)
    kept = docs.sparkSession.sparkContext.broadcast(
        (model.features, model.weights.astype(np.float32), model.bias)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()  # workers serve one step after the other
        features, weights, bias = kept.value
        weight_of = np.zeros(1 << FEATURE_BITS, np.float32)
        weight_of[features] = weights
        known = np.zeros(1 << FEATURE_BITS, bool)
        known[features] = True
        for rows, data, offsets in chunks(batches, limit=CHUNK_BYTES):
            parts = []
            for owner, feature in _hashed(data, offsets):
                hit = known[feature]
                parts.append((owner[hit] << FEATURE_BITS) | feature[hit])
            found = np.unique(np.concatenate(parts))
            owner = found >> FEATURE_BITS
            worth = weight_of[found & ((1 << FEATURE_BITS) - 1)].astype(float)
            n = rows.num_rows
            z = np.bincount(owner, worth, n) * _scale(np.bincount(owner, minlength=n)) + bias
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(_sigmoid(z))], names=[*rows.schema.names, column]
            )

    fields = [*docs.schema.fields, T.StructField(column, T.DoubleType())]
    return docs.mapInArrow(run, T.StructType(fields))


def held_out(doc_id, folds: int = 4, fold: int = 2):
    """Whether a document is kept from learning: crc32 of its id as text, by folds."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
    return F.coalesce(remainder == fold, F.lit(False))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``; columns stay as they are."""
    name = "toxicity_score"
    while name in docs.columns:
        name += "_"
    return score(docs, model, name).filter(F.col(name) < threshold).drop(name)
