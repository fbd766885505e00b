"""The language of web pages: text, declaration, address and host, weighed together.

Each source of evidence is a likelihood or a prior over the same languages, and
Bayes' rule adds their logarithms.  What a declaration or an address suffix says
about a language, and what a host usually publishes, is counted on the pages
themselves, with the text's own verdict as a soft label.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscale.llm.arrow_text import chunks, lower_ascii
from claimscale.sources.staging import stage

GRAM = 3  # bytes of UTF-8
FEATURE_BITS = 16
TEXT_WEIGHT = 50  # a long text weighs as much as so many of its grams
SMOOTHING = 0.5
PULL = 5.0  # pages' worth of trust in the next wider level
UNKNOWN = "und"

_HIDDEN = re.compile(
    r"<(script|style|template)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#\w]{1,10};", re.S | re.I
)
_PAGE = (
    "page_id long, host string, domain string, suffix string, declared string,"
    " text array<double>"
)


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which text each gram is of, and its hashed feature; digits count as blanks."""
    data = lower_ascii(data).copy()
    data[(data >= ord("0")) & (data <= ord("9"))] = 0x20
    n = max(len(data) - GRAM + 1, 0)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = np.arange(n) + GRAM <= offsets[1:][owner[:n]]
    value = np.zeros(n, np.uint32)
    for i in range(GRAM):
        value = (value << np.uint32(8)) | data[i : i + n]
    feature = (value * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURE_BITS)
    return owner[:n][inside], feature[inside].astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    for rows, data, offsets in chunks(batches):
        owner, feature = _grams(data, offsets)
        langs = np.array(rows.column("lang").to_pylist(), object)[owner]
        for lang in set(langs.tolist()):
            counts = held.setdefault(lang, np.zeros(1 << FEATURE_BITS, np.int64))
            counts += np.bincount(feature[langs == lang], minlength=1 << FEATURE_BITS)
    for lang, counts in held.items():
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(there), pa.string()),
                pa.array(there, pa.int32()),
                pa.array(counts[there], pa.int64()),
            ],
            names=["lang", "feature", "n"],
        )


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and per language the log-likelihoods of all features.

    Every text of ``docs`` (text, lang) counts; rows without a language don't.  Tasks
    count densely and send each feature once; the sums are languages times
    2 ** FEATURE_BITS at most, whatever the corpus.
    """
    told = docs.filter("lang is not null").select("lang", "text")
    sums = told.mapInArrow(_counts, "lang string, feature int, n long")
    sums = sums.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(sums.column("lang").to_pylist()))
    counts = np.full((len(langs), 1 << FEATURE_BITS), SMOOTHING)
    place = {lang: i for i, lang in enumerate(langs)}
    rows = np.array([place[x] for x in sums.column("lang").to_pylist()], np.int64)
    counts[rows, sums.column("feature").to_numpy()] += sums.column("n").to_numpy()
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True))


def visible_text(html: str | None) -> str:
    """What stands outside tags, scripts, styles and comments."""
    return _HIDDEN.sub(" ", html or "")


def host_of(url: Column) -> Column:
    """The host in lower case, without www. or m.; empty where there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][\w+.-]*://([^/?#:@]+)", 1)
    return F.regexp_replace(F.lower(host), r"^(www|m)\.", "")


def declared_language(html: Column) -> Column:
    """The language of the html tag without its region; UNKNOWN where none is declared."""
    said = F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)
    return F.when(F.coalesce(said, F.lit("")) == "", UNKNOWN).otherwise(F.lower(said))


def _text_scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [visible_text(h) for h in batch.column("html").to_pylist()]
            rest = batch.drop_columns(["html"])
            rest = pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(texts, pa.large_string())],
                names=[*rest.schema.names, "text"],
            )
            for rows, data, offsets in chunks(iter([rest])):
                owner, feature = _grams(data, offsets)
                n = rows.num_rows
                total = np.bincount(owner, minlength=n)
                weight = np.minimum(total, TEXT_WEIGHT) / np.maximum(total, 1)
                sums = [np.bincount(owner, one[feature], n) * weight for one in model]
                scores = np.stack(sums, 1) if len(model) else np.zeros((n, 0))
                yield pa.RecordBatch.from_arrays(
                    [*rows.drop_columns(["text"]).columns, pa.array(list(scores), pa.list_(pa.float64()))],
                    names=[f.split()[0] for f in _PAGE.split(", ")],
                )

    return run


def _normalised(logs: Column) -> Column:
    """Probabilities from an array of logarithms."""
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """The language of every page, learned from ``docs`` (text, lang).

    ``pages`` has page_id, url, html.  Returns one row per row: page_id, host,
    suffix, declared, text_language (by the text alone), language, probability.

    With p(l) the text's posterior, summed over pages for counts N:
    P(declared | l) and P(suffix | l) are (N + SMOOTHING) shares; the prior of a host
    is its own counts pulled towards those of its domain, which are pulled towards
    those of all pages, each with the weight of PULL pages; a page's own p is left
    out of its host's and domain's counts.

    Null or empty html has no text evidence and declares nothing; null and odd
    addresses share the host "" and suffix "".  Ties go to the first language by
    name.  Repeated rows count as pages each.  Without any learned language,
    language is null.  Empty tables give no rows; other columns are not read.

    Counts are aggregates by declaration, suffix, domain and host, with partial sums
    before each shuffle, so a host with a third of all pages is no burden.
    """
    langs, model = learn(docs)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    host = host_of(F.col("url"))
    parsed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        host.alias("host"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"),
        declared_language(F.col("html")).alias("declared"),
        "html",
    )
    scored = stage(parsed.mapInArrow(_text_scores(shared), _PAGE), "pages")
    k = len(langs)
    if not k:
        none = F.lit(None).cast("string")
        return scored.select(
            "page_id", "host", "suffix", "declared", none.alias("text_language"),
            none.alias("language"), F.lit(None).cast("double").alias("probability"),
        )
    scored = scored.withColumn("p", _normalised(F.col("text")))

    def counts(by: str, name: str) -> DataFrame:
        sums = F.array(*(F.sum(F.col("p")[i]) for i in range(k)))
        return scored.groupBy(by).agg(sums.alias(name))

    everything = scored.agg(F.array(*(F.sum(F.col("p")[i]) for i in range(k)))).first()[0]
    everything = np.array([x or 0.0 for x in everything]) + SMOOTHING
    world = F.array(*(F.lit(float(x)) for x in everything / everything.sum()))
    by_declared, by_suffix = counts("declared", "n_declared"), counts("suffix", "n_suffix")
    kinds = {c: scored.select(c).distinct().count() for c in ("declared", "suffix")}

    def likelihood(name: str, kind: str) -> Column:
        rows = F.array(*(F.lit(float(x + SMOOTHING * kinds[kind])) for x in everything - SMOOTHING))
        return F.zip_with(name, rows, lambda n, total: F.log((n + SMOOTHING) / total))

    def pulled(name: str, towards: Column) -> Column:
        own = F.zip_with(name, F.col("p"), lambda n, p: F.greatest(n - p, F.lit(0.0)))
        total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(own, towards, lambda n, t: (n + PULL * t) / (total + PULL))

    met = (
        scored.join(counts("host", "n_host"), "host")
        .join(counts("domain", "n_domain"), "domain")
        .join(by_suffix, "suffix")
        .join(F.broadcast(by_declared), "declared")  # two or three letters: 18,000 at most
        .withColumn("domain_prior", pulled("n_domain", world))
        .withColumn("prior", pulled("n_host", F.col("domain_prior")))
    )
    logs = F.transform("prior", lambda x: F.log(x))
    said, address = likelihood("n_declared", "declared"), likelihood("n_suffix", "suffix")
    for part in (F.col("text"), said, address):
        logs = F.zip_with(logs, part, lambda a, b: a + b)
    met = met.withColumn("q", _normalised(logs))
    names = F.array(*(F.lit(x) for x in langs))

    def best(column: str) -> Column:
        return F.element_at(names, F.array_position(F.col(column), F.array_max(column)).cast("int"))

    return met.select(
        "page_id",
        "host",
        "suffix",
        "declared",
        best("p").alias("text_language"),
        best("q").alias("language"),
        F.array_max("q").alias("probability"),
    )
