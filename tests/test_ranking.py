from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimscale.operators import ranking as R
from claimscale.plans.news import latest_per_key
from conftest import plan_of


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds nearly all rows, and many values are equal."""
    key = F.when(F.col("id") % 50 == 0, F.concat(F.lit("k"), F.col("id") % 7))
    return spark.range(0, 20_000, 1, 6).select(
        "id",
        F.coalesce(key, F.lit("hot")).alias("key"),
        F.pmod(F.hash("id"), F.lit(97)).alias("value"),
    )


def pairs(df):
    return {r["id"]: r["rank"] for r in df.collect()}


def windowed(df):
    window = Window.partitionBy("key").orderBy("value", "id")
    return df.withColumn("rank", F.row_number().over(window))


def order():
    return [F.asc("value"), F.asc("id")]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_ranges_equal_window(skewed, partitions):
    ranked = R.rank_by_ranges(skewed, ["key"], order(), partitions=partitions)
    assert ranked.columns == ["id", "key", "value", "rank"]
    assert pairs(ranked) == pairs(windowed(skewed))


def test_ranges_keep_null_keys(spark):
    rows = spark.range(40).select(
        "id", F.when(F.col("id") > 5, F.col("id") % 2).alias("key"), F.lit(1).alias("value")
    )
    ranked = R.rank_by_ranges(rows, ["key"], order(), partitions=3)
    assert pairs(ranked) == pairs(windowed(rows))


def test_ranges_without_keys(skewed):
    window = Window.orderBy("value", "id")
    want = pairs(skewed.withColumn("rank", F.row_number().over(window)))
    assert pairs(R.rank_by_ranges(skewed, [], order(), partitions=5)) == want
    assert pairs(R.rank_within(skewed, [], order())) == want


def test_ranges_of_nothing(skewed):
    assert R.rank_by_ranges(skewed.limit(0), ["key"], order()).count() == 0


def test_both_ways_of_rank_within(skewed):
    small = R.rank_within(skewed, ["key"], order())
    large = R.rank_within(skewed, ["key"], order(), one_task_rows=10)
    assert "Window" in plan_of(small)
    assert "Window [row_number" not in plan_of(large)
    assert pairs(small) == pairs(large)


def test_top_per_key(skewed):
    top = R.top_per_key(skewed, ["key"], order(), 3)
    want = {i: r for i, r in pairs(windowed(skewed)).items() if r <= 3}
    assert pairs(top) == want
    plan = plan_of(top)
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_top_per_key_above_the_group_limit(spark, skewed):
    spark.conf.set(R.GROUP_LIMIT_SETTING, "2")
    try:
        top = R.top_per_key(skewed, ["key"], order(), 5)
        want = {i: r for i, r in pairs(windowed(skewed)).items() if r <= 5}
        assert pairs(top) == want
    finally:
        spark.conf.unset(R.GROUP_LIMIT_SETTING)


def test_rank_score(spark):
    rows = spark.createDataFrame(
        [("a", 1, 0.1), ("b", 1, 0.2), ("c", 1, 0.2), ("a", 2, 0.0)],
        "organisation string, topic_id int, esg double",
    )
    for rounded, want in (
        (True, {("a", 1): 33.0, ("b", 1): 67.0, ("c", 1): 100.0, ("a", 2): 33.0}),
        (False, {("a", 1): 100 / 3, ("b", 1): 200 / 3, ("c", 1): 100.0, ("a", 2): 100 / 3}),
    ):
        scored = R.rank_score(
            rows, "topic_id", "esg", "organisation", rows, "organisation", rounded=rounded
        ).collect()
        got = {(r["organisation"], r["topic_id"]): r["score"] for r in scored}
        assert got == want
        assert all(0 < s <= 100 for s in got.values())


@pytest.fixture(scope="module")
def copied(spark):
    """Rows with copies in every task, equal dates, null dates and a null key."""
    made = spark.range(0, 6_000, 1, 6).select(
        F.when(F.col("id") % 5 < 4, F.concat(F.lit("k"), F.col("id") % 3)).alias("key"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.hash("id"), F.lit(9))).alias("date"),
        F.pmod(F.col("id"), F.lit(40)).alias("url"),
    )
    return made.unionByName(made.filter("url < 7"))


@pytest.mark.parametrize("n", [1, 30])
def test_latest_distinct_rows_both_ways(copied, n):
    first = latest_per_key(copied, "key", "date", n).collect()
    cut = latest_per_key(copied, "key", "date", n, many_copies=False)
    assert sorted(map(str, cut.collect())) == sorted(map(str, first))
    assert cut.columns == ["key", "date", "url", "rank"]
    # By hand: the distinct rows of a key in order, latest first, nulls last.
    rows = {tuple(r) for r in copied.filter("key = 'k1'").collect()}
    wanted = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))[:n]
    assert [tuple(r)[:3] for r in sorted(first, key=lambda r: r["rank"]) if r.key == "k1"] == wanted


def test_few_copies_are_cut_before_the_only_shuffle(copied):
    plan = plan_of(latest_per_key(copied, "key", "date", 3, many_copies=False))
    plan = plan[plan.index("== Physical Plan ==") :]
    assert plan.count("Exchange ") == 1
    assert "WindowGroupLimit" in plan[plan.index("Exchange ") :]


def test_beyond_the_group_limit_both_ways_are_one(copied):
    many = latest_per_key(copied, "key", "date", 1_001, many_copies=False)
    assert many.count() == copied.distinct().count()
