"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscale.llm import (
    collocations,
    exact_dedup,
    fingerprints,
    language_id,
    mixing,
    near_dedup,
    packing,
    phrase_automata,
    speculative_bpe,
    suffix_dedup,
    token_files,
    toxicity,
    vector_codes,
)
from claimscale.llm.shipping import ship
from claimscale.sources.staging import fresh_path


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_counts(_documents(spark, folder)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op5_phrase_automata(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_automata.remove_passages(_documents(spark, folder), with_rest=False)


def toxicity_model(docs: DataFrame, folder: str) -> toxicity.Model:
    """Learned from the labelled documents that are not held out."""
    labels = docs.sparkSession.read.parquet(f"{folder}/labels.parquet")
    return toxicity.fit(docs, labels.filter(~toxicity.held_out("doc_id")))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder).select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(docs, folder))
    return scored.select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return language_id.identify(pages, _documents(spark, folder))


def tokenizer_path() -> str:
    """The tokenizer of the registered queries; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_documents(spark, folder), with_rest=False)


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_likeness(_documents(spark, folder))


def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(_documents(spark, folder), size=2)


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_dedup.exact_groups(_documents(spark, folder))
    return groups.select(
        F.col("row_key").alias("doc_id"),
        F.col("keep_key").alias("keep_id"),
        "group_size",
        "kept",
        F.col("sha").alias("text_sha256"),
    )


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_documents(spark, folder), tokenizer_path())


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = fresh_path(spark, "token-files")
    token_files.write_token_files(_documents(spark, folder), target, tokenizer_path())
    return token_files.read_token_files(spark.read.parquet(target), checksums=True)


def op11_speculative_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder).select("doc_id", "text")
    both = speculative_bpe.encode(docs, tokenizer_path(), decoded="decoded")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    codes = vector_codes.compress(spark.read.parquet(f"{folder}/embeddings.parquet"))
    digest = vector_codes.codebook_digest(codes.codebooks)
    return vector_codes.with_label_errors(codes.rows).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_documents(spark, folder))


LLM_QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_fingerprints": op3_fingerprints,
    "op4_near_dedup": op4_near_dedup,
    "op5_phrase_automata": op5_phrase_automata,
    "op6_toxicity": op6_toxicity,
    "op7_language_id": op7_language_id,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_packing": op9_packing,
    "op10_token_files": op10_token_files,
    "op11_speculative_bpe": op11_speculative_bpe,
    "op12_vector_codes": op12_vector_codes,
    "op13_collocations": op13_collocations,
}
