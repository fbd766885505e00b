from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimscale.operators import joins as J
from conftest import plan_of


@pytest.fixture(scope="module")
def facts(spark):
    """A third of all rows on one key, some keys without a partner, some null."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 101 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 1500))
    )
    return spark.range(0, 9000, 1, 5).select("id", key.alias("key"))


@pytest.fixture(scope="module")
def lookup(spark):
    keys = spark.range(1000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    named = keys.unionByName(spark.createDataFrame([("hot",), ("hot",)], "key string"))
    return named.withColumn("name", F.monotonically_increasing_id())


def rows(df):
    return sorted(tuple(r) for r in df.select("id", "key", "name").collect())


def test_split_join_equals_plain_join(facts, lookup):
    want = rows(facts.join(lookup, "key"))
    assert rows(J.split_join(facts, lookup, ["key"])) == want
    assert rows(J.split_join(facts, lookup, ["key"], share=0.9)) == want
    assert rows(J.split_join(facts, lookup, ["key"], fraction=0.01)) == want


def test_heavy_key_is_spread(spark, facts, lookup):
    assert [r["key"] for r in J.heavy_keys(facts, ["key"], 0.05).collect()] == ["hot"]


def test_lookup_join_broadcasts_by_measured_size(facts, lookup):
    small = J.lookup_join(facts, lookup, ["key"])
    large = J.lookup_join(facts, lookup, ["key"], max_bytes=10)
    assert "ResolvedHint (strategy=broadcast)" in plan_of(small) or "BroadcastHashJoin" in plan_of(small)
    assert "_salt" in plan_of(large) and "_salt" not in plan_of(small)
    assert rows(small) == rows(large)


def test_measured_size_counts_nulls(spark):
    df = spark.createDataFrame([("ab", 1), ("é", 2), (None, None)], "a string, b int")
    assert J.held_bytes(df) == 3 * 2 * J.VALUE_BYTES + 4
    assert J.held_bytes(df.limit(0)) == 0
    nulls = spark.range(10).select(*(F.lit(None).cast("long").alias(f"c{i}") for i in range(20)))
    assert J.held_bytes(nulls) == 10 * 20 * J.VALUE_BYTES


def test_equal_rows_of_one_key_spread_over_many_tasks(spark):
    rows = spark.range(0, 20000, 1, 4).select(F.lit("hot").alias("key"), F.lit(1).alias("same"))
    lookup = spark.createDataFrame([("hot", "x")], "key string, name string")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = J.split_join(rows, lookup, ["key"])
        tasks = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert len(tasks) > 32 and sum(r["count"] for r in tasks) == 20000
        assert max(r["count"] for r in tasks) < 2500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_salts_come_from_written_rows(spark, facts, lookup):
    """A task that runs again must salt alike, though rows reach it in any order."""
    moved = facts.repartition(7, "key").filter(F.col("id") >= 0)
    joined = J.split_join(moved, lookup, ["key"])
    below = plan_of(joined).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "Repartition" not in below and "claimscale/" in plan_of(joined)
    assert rows(joined) == rows(moved.join(lookup, "key"))
    # A second run over the same files gives each row its salt again, whatever the order.
    salted = spark.read.parquet(next(p for p in joined.inputFiles() if "/facts-" in p).rsplit("/", 1)[0])
    numbered = salted.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    assert sorted(map(repr, numbered.collect())) == sorted(map(repr, numbered.collect()))
