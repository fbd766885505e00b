"""Accents and compatibility forms of all of Unicode, taken off distinct terms."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscale.sources.staging import stage


def folded(sign: str) -> str:
    """A sign's compatibility decomposition without combining marks."""
    parts = unicodedata.normalize("NFKD", sign)
    return "".join(c for c in parts if not unicodedata.combining(c))


def folding_table(spark: SparkSession) -> DataFrame:
    """sign, plain: every sign that changes; some become several signs, marks become none.

    There are as many rows as Unicode has such signs, some 18,000, whatever the corpus.
    """
    signs = (chr(c) for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    rows = [(s, folded(s)) for s in signs if folded(s) != s]
    return spark.createDataFrame(rows, "sign string, plain string")


def folded_terms(terms: DataFrame) -> DataFrame:
    """term, base: of a table of distinct terms, as ``dictionary.dictionary`` takes it.

    The base is in small letters, without accents and compatibility forms: a ligature
    becomes its letters, a full-width letter the usual one, a syllable of Hangul its
    parts.  Only terms with a sign beyond ASCII are taken apart; their signs meet the
    table in a broadcast join.
    """
    low = F.lower("term")
    held = stage(terms.select("term", low.alias("low")), "terms")
    usual = F.col("low").rlike("^[\\x00-\\x7F]*$")
    signs = held.filter(~usual).select("term", F.posexplode(F.split("low", "")).alias("at", "sign"))
    joined = signs.join(F.broadcast(folding_table(terms.sparkSession)), "sign", "left")
    part = F.struct("at", F.coalesce("plain", "sign").alias("plain"))
    parts = joined.groupBy("term").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    changed = parts.select("term", F.array_join(F.col("parts.plain"), "").alias("base"))
    same = held.filter(usual).select("term", F.col("low").alias("base"))
    return same.unionByName(changed)
