"""From raw documents to packed training sequences.

Each stage works on all that the one before kept, which is written to the shared
folder and read again in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscale.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from claimscale.llm.registered import tokenizer_path, toxicity_model
from claimscale.llm.shipping import ship
from claimscale.sources.staging import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects; it learns from the labels table."""
    ship(spark)
    return toxicity.drop_toxic(docs, toxicity_model(docs, sf_dir))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    ship(spark)
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the one with the smallest doc_id."""
    ship(spark)
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; cut texts get their own length."""
    ship(spark)
    mixed = mixing.mix(docs)
    if "n_chars" not in mixed.columns:
        return mixed
    return mixed.withColumn("n_chars", F.least("n_chars", F.length("text").cast("long")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1024 ids."""
    ship(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A trained classifier and a tokenizer decide about rows: no SQL says the same.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that all stages leave of the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
