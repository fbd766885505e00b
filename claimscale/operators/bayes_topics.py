"""Topic model by full passes of variational Bayes; the topic matrix is a table.

A bucket of texts gets the matrix's row of each of its terms once, whatever the number of
texts that hold it, infers their topics, and gives one row per term back.  Only one number
per topic and the bound of the likelihood reach the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscale import fixed
from claimscale.functions.text import tokens as text_tokens
from claimscale.operators.dictionary import by_chunks, dictionary, term_bags, terms_of_chunks
from claimscale.operators.joins import BROADCAST_BYTES
from claimscale.operators.ranking import top_per_key
from claimscale.operators.variational import digamma, log_gamma, settle, text_bounds
from claimscale.session import shuffle_width
from claimscale.shipping import ship
from claimscale.sources.staging import fresh_path, stage

# Texts fall into buckets: enough for the tasks, and beyond that by what a task may hold.
# Each term costs a row of numbers per bucket and pass, so these are large.
ROWS_PER_BUCKET, MANY_BUCKETS, BUCKET_TOKENS = 2_000, 24, 8_000_000
MOST_ROWS, MOST_TOKENS = 50_000, 2_000_000  # of a chunk to score
BLOCK_ROWS = 1 << 16
PASSES = 20
TOLERANCE = 1e-4  # of the bound, relative: the passes end there
EXACT = "decimal(38, 18)"  # sums of these do not depend on the order of the rows

_SUMS = "bucket int, term_id long, s array<double>"
_MATRIX = "term_id long, weights array<double>, buckets array<int>"
_LOGS = "term_id long, logs array<double>, buckets array<int>"
_PARTS = "term_id long, weights array<double>, parts array<double>"
_TOLD = "tokens long, log_likelihood double"
_META = "meta string"


@dataclass
class BayesTopics:
    """A fitted model: numbers per topic, and where the matrix of its terms is."""

    path: str
    topics: int
    terms: int
    alpha: float
    eta: float
    forms: int  # words that stand for the terms; as many, unless these are base forms
    totals: list[float]  # sums of the matrix by topic
    bounds: list[float] = field(default_factory=list)  # of the likelihood, by pass

    def matrix(self) -> DataFrame:
        """term_id, term, base, count, is_first, weights (per topic), logs (exp of digamma of these).

        One row per form; the first form of a base is marked.
        """
        return SparkSession.active().read.parquet(f"{self.path}/terms")

    def factors(self) -> list[float]:
        """What makes ``logs`` the exponentials of expected logarithms."""
        return np.exp(-digamma(np.array(self.totals))).tolist()

    def is_small(self) -> bool:
        """Whether the terms and their logs may be broadcast."""
        return self.forms * (8 * self.topics + 64) <= BROADCAST_BYTES


def _lists(values: np.ndarray) -> pa.Array:
    bounds = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values.ravel()))


def _rows(column: pa.ChunkedArray | pa.Array, k: int) -> np.ndarray:
    """A column of lists of ``k`` numbers as a matrix."""
    return column.combine_chunks().flatten().to_numpy().reshape(-1, k)


def _matrix_rows(eta: float):
    """Sums of what the buckets add to each term, in their order, become the matrix's rows.

    Below no term stand the sums of the texts' bounds, which pass through.  A row
    remembers the buckets that hold its term.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _whole(batches, "term_id"):
            term = block.column("term_id").to_numpy()
            first = _starts(term)
            sums = block.column("s").flatten().to_numpy().reshape(len(term), -1)
            sums = np.add.reduceat(sums, first)
            weights = np.where(term[first][:, None] >= 0, sums + eta, sums)
            ends = pa.array(np.append(first, len(term)).astype(np.int32))
            buckets = pa.ListArray.from_arrays(ends, block.column("bucket"))
            columns = [pa.array(term[first]), _lists(weights), buckets]
            yield pa.RecordBatch.from_arrays(columns, names=["term_id", "weights", "buckets"])

    return run


def _log_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``weights`` become ``logs``, the exponentials of their digamma."""
    for batch in batches:
        if not batch.num_rows:
            continue
        weights = batch.column("weights").flatten().to_numpy().reshape(batch.num_rows, -1)
        at = batch.schema.get_field_index("weights")
        yield batch.set_column(at, "logs", _lists(np.exp(digamma(weights))))


def _with_logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights and, beside them, their ``logs``."""
    for batch in batches:
        for logs in _log_rows(iter([batch.select(["weights"])])):
            columns = [batch.column("term_id"), batch.column("weights"), logs.column("logs")]
            yield pa.RecordBatch.from_arrays(columns, names=["term_id", "weights", "logs"])


def _part_rows(eta: float):
    """Adds what each term's weights add to the bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            term = batch.column("term_id").to_numpy()
            weights = batch.column("weights").flatten().to_numpy().reshape(len(term), -1)
            safe = np.where(term[:, None] >= 0, weights, 1.0)
            parts = (eta - safe) * digamma(safe) + log_gamma(safe)
            columns = [batch.column("term_id"), batch.column("weights"), _lists(parts)]
            yield pa.RecordBatch.from_arrays(columns, names=["term_id", "weights", "parts"])

    return run


def _whole(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Blocks of rows that hold all rows of each ``key``; these come one after the other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < BLOCK_ROWS:
            continue
        block = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        keys = block.column(key).to_numpy()
        new = np.flatnonzero(keys[1:] != keys[:-1])
        cut = int(new[-1]) + 1 if len(new) else 0
        if cut:
            yield block.slice(0, cut)
        held = [block.slice(cut)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _starts(keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)


def _blocks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts with about ``BLOCK_ROWS`` terms, as (first, behind the last)."""
    ends = np.cumsum(sizes)
    a = 0
    while a < len(sizes):
        done = ends[a - 1] if a else 0
        b = max(int(np.searchsorted(ends, done + BLOCK_ROWS, "right")), a + 1)
        yield a, b
        a = b


def _pass_over_texts(alpha: float, factors: Sequence[float]):
    """What the texts of a bucket add to each of its terms; under -1 their bounds.

    Sums are made per bucket, whose texts are in a fixed order, so they don't depend on
    how buckets fall into tasks.
    """
    factor = np.array(factors)
    k = len(factor)

    def run(texts: pa.Table, logs: pa.Table) -> pa.Table:
        bucket = texts.column("bucket")[0].as_py()
        order = np.lexsort((texts.column("row").to_numpy(), texts.column("place").to_numpy()))
        texts = texts.take(pa.array(order))
        terms, counts = (texts.column(c).combine_chunks() for c in ("terms", "counts"))
        sizes = pc.list_value_length(terms).to_numpy()
        ends = np.append(0, np.cumsum(sizes))
        logs = logs.sort_by("term_id")
        ids = logs.column("term_id").to_numpy()
        rows = _rows(logs.column("logs"), k) * factor
        at = np.searchsorted(ids, terms.flatten().to_numpy())
        n = counts.flatten().to_numpy().astype(np.float64)
        sums, bound = np.zeros((len(ids) + 1, k)), 0.0
        for a, b in _blocks(sizes):
            part = slice(ends[a], ends[b])
            first = ends[a:b] - ends[a]
            weights, adds = settle(n[part], rows[at[part]], first, alpha)
            bound += float(text_bounds(n[part], rows[at[part]], first, weights, alpha).sum())
            for i in range(k):
                sums[:-1, i] += np.bincount(at[part], adds[:, i], len(ids))
        sums[-1, 0] = bound
        names = ["bucket", "term_id", "s"]
        columns = [pa.array(np.full(len(sums), bucket, np.int32)), pa.array(np.append(ids, -1)), _lists(sums)]
        return pa.Table.from_arrays(columns, names=names)

    return run


def _exact_sums(values: str, k: int, where: str = "true") -> list:
    return [
        F.expr(f"CAST(SUM(CAST({values}[{i}] AS {EXACT})) FILTER (WHERE {where}) AS DOUBLE)").alias(
            f"{values}{i}"
        )
        for i in range(k)
    ]


def _topic_bound(parts: np.ndarray, totals: np.ndarray, terms: int, eta: float) -> float:
    """The matrix's part of the bound."""
    found = parts - (terms * eta - totals) * digamma(totals) - log_gamma(totals)
    return float((found + log_gamma(terms * eta) - terms * log_gamma(eta)).sum())


def _totals(matrix: DataFrame, k: int, eta: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Per topic the sums of weights and of the bound's parts; and the texts' bound."""
    aggregates = _exact_sums("weights", k, "term_id >= 0") + _exact_sums("parts", k, "term_id >= 0")
    texts = F.sum(F.when(F.col("term_id") < 0, F.get("weights", F.lit(0))))
    parts = matrix.select("term_id", "weights").mapInArrow(_part_rows(eta), _PARTS)
    row = parts.agg(*aggregates, F.coalesce(texts, F.lit(0.0))).first()
    return np.array(row[:k]), np.array(row[k : 2 * k]), row[2 * k]


def _random_start(known: DataFrame, k: int, seed: int, eta: float) -> DataFrame:
    """Weights that depend on nothing but the term, the topic and the seed."""
    hashed = [F.xxhash64("base", F.lit(i), F.lit(seed)) for i in range(k)]
    unit = [0.5 + F.pmod(h, F.lit(1 << 32)) / float(1 << 32) + F.lit(float(eta)) for h in hashed]
    return known.filter("is_first").select("term_id", F.array(*unit).alias("weights"))


def _logs(matrix: DataFrame) -> DataFrame:
    """bucket, term_id, logs: for each bucket the rows of its own terms."""
    rows = matrix.filter(F.col("term_id") >= 0).select("term_id", "weights", "buckets")
    rows = rows.mapInArrow(_log_rows, _LOGS)
    return rows.select(F.explode("buckets").alias("bucket"), "term_id", "logs")


def fit(
    documents: DataFrame,
    text: str = "statement",
    order: Sequence[str] = (),
    topics: int = len(fixed.TOPIC_LABELS),
    seed: int = fixed.MODEL_SEED,
    passes: int = PASSES,
    tolerance: float = TOLERANCE,
    stop_words: Sequence[str] = fixed.STOP_WORDS,
    vocabulary_size: int | None = None,
    alpha: float | None = None,
    eta: float | None = None,
    bases: Callable[[DataFrame], DataFrame] | None = None,
    path: str | None = None,
) -> BayesTopics:
    """Fit ``topics`` topics; every text counts in every pass.

    Passes end after ``passes`` of them, or when the bound of the likelihood grows by
    less than ``tolerance`` of itself.  All terms count unless ``vocabulary_size`` limits
    them; ``bases`` (see ``dictionary``) makes base forms of them, and other texts are then
    scored by the forms that were seen; the priors are 1 / topics unless given.  Texts are dealt to buckets by a hash
    of ``order``, columns that identify a row (without them: of the text's terms); a term's
    sum is made in the order of the buckets, so the model depends on neither the cluster
    nor the order of the rows.  Texts without terms take no part.

    In a pass a row of numbers per term and bucket goes each way.  The texts' term numbers
    go to their buckets once, before the passes, and stay on disk there.
    """
    spark = documents.sparkSession
    ship(spark)
    alpha, eta = alpha or 1 / topics, eta or 1 / topics
    texts = documents.select(*order, F.col(text).alias("_text"))
    place = F.xxhash64(*order) if order else F.xxhash64("tokens")
    split = texts.withColumn("tokens", text_tokens("_text", stop_words)).drop("_text")
    rows = split.withColumns({"place": place, "row": F.monotonically_increasing_id()})
    listed = stage(rows.select("place", "row", "tokens"), "tokens")
    known = stage(dictionary(listed, size=vocabulary_size, bases=bases), "dictionary")
    forms, terms = known.agg(F.count(F.lit(1)), F.count_if("is_first")).first()
    if not terms:
        raise ValueError("the texts hold no terms to learn from")
    rows, n_tokens = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("tokens")), F.lit(0))).first()
    buckets = max(min(rows // ROWS_PER_BUCKET, MANY_BUCKETS), n_tokens // BUCKET_TOKENS) + 1
    bucket = F.pmod("place", F.lit(buckets)).cast("int")
    bags = term_bags(listed, known, ["place", "row"], unique=True).withColumn("bucket", bucket)
    bags = stage(
        bags.select(
            "bucket", "place", "row", F.col("bag.term_id").alias("terms"), F.col("bag.n").alias("counts")
        ),
        "bags",
    )
    held = bags.select("bucket", F.explode("terms").alias("term_id")).distinct()
    held = held.groupBy("term_id").agg(F.collect_list("bucket").alias("buckets"))
    matrix = stage(_random_start(known, topics, seed, eta).join(held, "term_id"), "matrix")
    model = BayesTopics(path or fresh_path(spark, "topics"), topics, terms, alpha, eta, forms, [])
    totals, parts, _ = _totals(matrix, topics, eta)
    width = shuffle_width(spark)
    placed = bags.repartition(width, "bucket").sortWithinPartitions("bucket").persist(StorageLevel.DISK_ONLY)
    try:
        placed.count()  # a plan knows how a table is placed once that is done
        for _ in range(passes):
            model.totals = totals.tolist()
            of_topics = _topic_bound(parts, totals, terms, eta)
            met = placed.groupBy("bucket").cogroup(_logs(matrix).groupBy("bucket"))
            added = met.applyInArrow(_pass_over_texts(alpha, model.factors()), _SUMS)
            sums = added.repartition(width, "term_id").sortWithinPartitions("term_id", "bucket")
            matrix = stage(sums.mapInArrow(_matrix_rows(eta), _MATRIX), "matrix")
            totals, parts, of_texts = _totals(matrix, topics, eta)
            model.bounds.append(of_topics + of_texts)
            if len(model.bounds) > 1:
                before, now = model.bounds[-2:]
                if now - before < tolerance * abs(before):
                    break
    finally:
        placed.unpersist()
    model.totals = totals.tolist()
    rows = matrix.filter(F.col("term_id") >= 0).select("term_id", "weights")
    rows = rows.mapInArrow(_with_logs, "term_id long, weights array<double>, logs array<double>")
    rows.join(known, "term_id").write.mode("overwrite").parquet(f"{model.path}/terms")
    return model


def save(model: BayesTopics, path: str) -> None:
    """The model's terms and numbers under ``path``."""
    spark = SparkSession.active()
    if path != model.path:
        model.matrix().write.mode("overwrite").parquet(f"{path}/terms")
    meta = json.dumps(asdict(model) | {"path": path})
    one = spark.createDataFrame([(meta,)], _META).coalesce(1)
    one.write.mode("overwrite").text(f"{path}/bayes")


def load(path: str) -> BayesTopics:
    rows = SparkSession.active().read.text(f"{path}/bayes").collect()
    return BayesTopics(**(json.loads(rows[0][0]) | {"path": path}))


def _inferred(alpha: float, factors: Sequence[float], kept: Sequence[str], names: Sequence[str]):
    """One row per text with its distribution; rows without a known term have null logs."""
    factor = np.array(factors)
    k = len(factor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _whole(batches, "row"):
            first = _starts(block.column("row").to_numpy())
            weights = np.full((len(first), k), alpha)
            logs = block.column("logs")
            known = logs.is_valid().to_numpy(zero_copy_only=False)
            if known.any():
                terms = logs.filter(pa.array(known)).flatten().to_numpy().reshape(-1, k) * factor
                text = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(known))))[known]
                found, _ = settle(np.ones(len(text)), terms, _starts(text), alpha)
                weights[np.unique(text)] = found
            shares = weights / weights.sum(1)[:, None]
            rows = block.take(pa.array(first))
            columns = [rows.column(c) for c in kept] + [_lists(shares)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "shares"])

    return run


def _beside_terms(model: BayesTopics, rows: DataFrame, *columns: str):
    """Chunks of written rows (row, tokens), each with the matrix's rows of its own terms."""
    rows = by_chunks(rows, "tokens", MOST_ROWS, MOST_TOKENS)
    known = terms_of_chunks(rows, "tokens", model.matrix().select("term", *columns))
    return rows.groupBy("chunk").cogroup(known.groupBy("of"))


def _known_places(rows: pa.Table, terms: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """For each known token of the rows the number of its row and of its term's row."""
    tokens = rows.column("tokens").combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy()
    found = pc.index_in(tokens.flatten(), value_set=terms.column("term").combine_chunks())
    known = found.is_valid().to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(sizes)), sizes)[known]
    return of, found.drop_null().to_numpy().astype(np.int64)


def _settled(of: np.ndarray, at: np.ndarray, logs: np.ndarray, alpha: float, n: int) -> np.ndarray:
    """Topic weights of ``n`` texts; ``alpha`` for those without a known term."""
    weights = np.full((n, logs.shape[1]), alpha)
    sizes = np.bincount(of, minlength=n)
    texts = np.flatnonzero(sizes)
    sizes = sizes[texts]
    ends = np.append(0, np.cumsum(sizes))
    for a, b in _blocks(sizes):
        part = at[ends[a] : ends[b]]
        weights[texts[a:b]], _ = settle(np.ones(len(part)), logs[part], ends[a:b] - ends[a], alpha)
    return weights


def _scored_chunk(alpha: float, factors: Sequence[float]):
    """The rows of a chunk with their distributions."""
    factor = np.array(factors)

    def run(rows: pa.Table, terms: pa.Table) -> pa.Table:
        of, at = _known_places(rows, terms)
        logs = _rows(terms.column("logs"), len(factor)) * factor
        weights = _settled(of, at, logs, alpha, rows.num_rows)
        shares = _lists(weights / weights.sum(1)[:, None])
        return pa.Table.from_arrays([rows.column("held"), shares], names=["held", "shares"])

    return run


def _told_chunk(alpha: float, factors: Sequence[float], totals: Sequence[float]):
    """Known tokens of a chunk, and the logarithm of their likelihood."""
    factor, total = np.array(factors), np.array(totals)
    k = len(factor)

    def run(rows: pa.Table, terms: pa.Table) -> pa.Table:
        of, at = _known_places(rows, terms)
        weights = _settled(of, at, _rows(terms.column("logs"), k) * factor, alpha, rows.num_rows)
        shares = weights / weights.sum(1)[:, None]
        words = _rows(terms.column("weights"), k) / total
        told = 0.0
        for a in range(0, len(of), BLOCK_ROWS):
            part = slice(a, a + BLOCK_ROWS)
            told += float(np.log((shares[of[part]] * words[at[part]]).sum(1)).sum())
        columns = [pa.array([len(of)], pa.int64()), pa.array([told if len(of) else None], pa.float64())]
        return pa.Table.from_arrays(columns, names=["tokens", "log_likelihood"])

    return run


def distributions(
    model: BayesTopics, documents: DataFrame, text: str = "statement", stop_words: Sequence[str] = fixed.STOP_WORDS
) -> DataFrame:
    """Add the topic distribution as array<double> ``probabilities``.

    Every row stays; a text without a known term has the flat distribution 1/k.  A
    column named ``probabilities`` is replaced.  With a broadcast matrix no row moves:
    a row travels with the first of its terms.  Beyond that chunks of the written rows
    meet the matrix's rows of their terms.
    """
    spark = documents.sparkSession
    ship(spark)
    split = documents.withColumn("_tokens", F.array_sort(text_tokens(f"`{text}`", stop_words)))
    columns = [c for c in documents.columns if c != "probabilities"]
    held = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    rows = split.select(held.alias("held"), "_tokens", F.monotonically_increasing_id().alias("row"))
    kind = T.ArrayType(T.DoubleType())
    if model.is_small():
        logs = model.matrix().select("term", "logs")
        terms = rows.select("row", "held", F.posexplode_outer("_tokens").alias("at", "term"))
        first = F.coalesce("at", F.lit(0)) == 0
        terms = terms.withColumn("held", F.when(first, F.col("held")))
        joined = terms.join(F.broadcast(logs), "term", "left").select("row", "at", "held", "logs")
        joined = joined.sortWithinPartitions("row", "at")
        schema = T.StructType([joined.schema["held"], T.StructField("shares", kind)])
        found = joined.mapInArrow(_inferred(model.alpha, model.factors(), ["held"], ["held"]), schema)
    else:
        rows = stage(rows.withColumnRenamed("_tokens", "tokens"), "to-score")
        schema = T.StructType([rows.schema["held"], T.StructField("shares", kind)])
        met = _beside_terms(model, rows, "logs")
        found = met.applyInArrow(_scored_chunk(model.alpha, model.factors()), schema)
    out = [F.col(f"held.c{i}").alias(c) for i, c in enumerate(columns)]
    return found.select(*out, F.col("shares").alias("probabilities"))


def topic_terms(model: BayesTopics, n: int = 10) -> DataFrame:
    """The ``n`` heaviest terms per topic: topic_id, rank, term, weight (share of the topic)."""
    totals = F.array(*[F.lit(t) for t in model.totals])
    weights = model.matrix().filter("is_first").select(
        "term_id", F.col("base").alias("term"), F.posexplode("weights").alias("topic_id", "w")
    )
    shared = weights.withColumn("weight", F.col("w") / F.get(totals, F.col("topic_id")))
    best = top_per_key(
        shared.select("topic_id", "term", "weight"), ["topic_id"], [F.desc("weight"), F.asc("term")], n
    )
    return best.select("topic_id", "rank", "term", "weight")


def log_likelihood(model: BayesTopics, documents: DataFrame, text: str = "statement") -> DataFrame:
    """tokens, log_likelihood: of the known terms of all texts, by their own distributions."""
    if not model.is_small():
        ship(documents.sparkSession)
        tokens = F.array_sort(text_tokens(f"`{text}`")).alias("tokens")
        rows = stage(documents.select(tokens, F.monotonically_increasing_id().alias("row")), "to-tell")
        met = _beside_terms(model, rows, "logs", "weights")
        told = met.applyInArrow(_told_chunk(model.alpha, model.factors(), model.totals), _TOLD)
        return told.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.sum("log_likelihood").alias("log_likelihood"))
    scored = distributions(model, documents.select(F.col(f"`{text}`").alias("_scored")), "_scored")
    rows = scored.select(F.col("probabilities").alias("p"), F.explode(text_tokens("_scored")).alias("term"))
    totals = [F.lit(t) for t in model.totals]
    weights = model.matrix().select("term", "weights")
    joined = rows.join(F.broadcast(weights), "term")
    share = sum(
        (F.get("p", F.lit(i)) * F.get("weights", F.lit(i)) / totals[i] for i in range(model.topics)),
        F.lit(0.0),
    )
    return joined.agg(F.count(F.lit(1)).alias("tokens"), F.sum(F.log(share)).alias("log_likelihood"))
