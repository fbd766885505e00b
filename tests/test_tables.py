from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimscale.sources import exports, files, tables
from claimscale.sources.staging import fresh_path, stage
from conftest import plan_of


@pytest.fixture
def schema(spark):
    return tables.fresh_schema(spark)


@pytest.fixture
def numbers(spark):
    return spark.range(100).select((F.col("id") % 4).cast("int").alias("part"), "id")


def test_partitioned_table_insert_and_append(spark, schema):
    name = f"{schema}.t"
    tables.create_table(spark, name, "columnA INT, columnB STRING", ["columnA"])
    tables.create_table(spark, name, "columnA INT, columnB STRING", ["columnA"])
    tables.insert_values(spark, name, ["columnA", "columnB"], "(1, 'one'), (2, 'two')")
    more = spark.createDataFrame([(60, "x")], "columnA int, columnB string")
    tables.append_table(more, name, ["columnA"])
    got = spark.table(name).select("columnA", "columnB").collect()
    assert sorted(map(tuple, got)) == [(1, "one"), (2, "two"), (60, "x")]
    assert tables.partition_columns(spark, name) == ["columnA"]
    plan = plan_of(spark.table(name).filter("columnA = 1"))
    assert "PartitionFilters: [isnotnull(columnA" in plan


def test_dropping_external_keeps_files_managed_does_not(spark, schema, numbers):
    path = fresh_path(spark, "external")
    files.replace_path(numbers, path)
    tables.register_files(spark, f"{schema}.ext", path)
    tables.drop_table(spark, f"{schema}.ext", must_exist=True)
    assert files.read_path(spark, path).count() == 100
    tables.replace_table(numbers, f"{schema}.managed")
    location = tables.location_of(spark, f"{schema}.managed")
    assert spark.read.parquet(location).count() == 100
    tables.drop_table(spark, f"{schema}.managed")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(location)
    tables.drop_table(spark, f"{schema}.managed")
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        tables.drop_table(spark, f"{schema}.managed", must_exist=True)


def test_schema_commands(spark, schema, numbers):
    name = f"{schema}_b"
    tables.create_schema(spark, name, fresh_path(spark, "schema"), "it's a comment")
    assert name in {r[0] for r in tables.show_schemas(spark).collect()}
    described = {r[0]: r[1] for r in tables.describe_schema(spark, name).collect()}
    assert described["Comment"] == "it's a comment"
    tables.replace_table(numbers, f"{name}.n")
    shown = tables.show_tables(spark, name).filter("not isTemporary").collect()
    assert [r["tableName"] for r in shown] == ["n"]


def test_copy_keeps_partitions_and_is_independent(spark, schema, numbers):
    tables.replace_table(numbers, f"{schema}.a", ["part"])
    tables.copy_table(spark, f"{schema}.a", f"{schema}.b")
    tables.create_table_as(spark, f"{schema}.c", f"SELECT * FROM {schema}.a")
    tables.drop_table(spark, f"{schema}.a")
    assert tables.partition_columns(spark, f"{schema}.b") == ["part"]
    assert tables.partition_columns(spark, f"{schema}.c") == []
    for name in ("b", "c"):
        assert spark.table(f"{schema}.{name}").select("part", "id").exceptAll(numbers).count() == 0


def test_clustered_files_have_disjoint_ranges_and_hot_keys_are_cut(spark):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, F.lit(500)).otherwise(F.col("id") % 1000).alias("k"), "id"
    )
    path = fresh_path(spark, "clustered")
    files.replace_path(files.clustered(rows, "k", ["id"], files=8), path)
    per_file = (
        files.read_path(spark, path)
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count("*").alias("n"))
        .orderBy("low", "high")
        .collect()
    )
    assert all(a["high"] <= b["low"] for a, b in zip(per_file, per_file[1:]))
    assert sum(r["low"] <= 500 <= r["high"] for r in per_file) >= 4
    assert max(r["n"] for r in per_file) < 20_000


def test_exports(spark, numbers):
    folder = fresh_path(spark, "export")
    exports.export_table(numbers, folder, "s", "d", "all", ("part",))
    one = exports.export_table(numbers, folder, "s", "d", "one", partition={"part": 1})
    exports.export_table(numbers, folder, "s", "d", "one", partition={"part": 1})
    listed = exports.exported_tables(spark, folder).orderBy("table").collect()
    assert [(r["table"], r["partition"]) for r in listed] == [("all", ""), ("one", "part = 1")]
    assert exports.read_export(spark, one).count() == 25
    exports.export_table(numbers, folder, "s", "d", "again", partition={"part": 1})
    exports.export_table(numbers, folder, "s", "d", "again")
    again = exports.exported_tables(spark, folder).filter("table = 'again'").collect()
    assert [r["partition"] for r in again] == [""]
    name = f"{tables.fresh_schema(spark)}.shared"
    exports.register_export(spark, one, name)
    assert spark.table(name).count() == 25


def test_delimited_and_json(spark):
    rows = spark.createDataFrame(
        [("Org A", "does, things", "A", "u", "l")], files.ORGANISATION_SCHEMA
    )
    path = fresh_path(spark, "csv")
    files.write_delimited(rows, path)
    assert files.read_delimited(spark, path).collect() == rows.collect()
    path = fresh_path(spark, "json")
    files.topic_dimension(spark).write.json(path)
    back = files.read_json(spark, path)
    assert back.dtypes[0] == ("topic_id", "int")
    assert back.count() == 5


def test_stage_is_a_written_table(spark, numbers):
    frozen = stage(numbers)
    assert "FileScan parquet" in plan_of(frozen)
    assert frozen.exceptAll(numbers).count() == 0


def test_spread_leaves_wide_scans_alone(spark):
    wide = spark.range(0, 1000, 1, 64)
    assert files.spread(wide) is wide
    assert files.spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() > 1


def test_hot_partition_is_written_by_several_tasks(spark, schema):
    rows = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 5))
        .alias("part"),
        F.xxhash64("id").alias("value"),
    )
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(advisory, "256k")
    try:
        tables.replace_table(rows, f"{schema}.skewed", ["part"])
    finally:
        spark.conf.unset(advisory)
    written = spark.table(f"{schema}.skewed")
    files_of = {
        r["part"]: r["n"]
        for r in written.select("part", F.input_file_name().alias("f"))
        .distinct()
        .groupBy("part")
        .agg(F.count("f").alias("n"))
        .collect()
    }
    assert files_of["hot"] > 2
    assert written.count() == 400_000


def test_initiative_filter_reaches_the_scan(spark, schema):
    from claimscale.plans import disclosure

    rows = spark.range(10).select(
        F.lit("a").alias("organisation"), F.lit(0).alias("topic_id"), "id",
        (F.col("id") / 10).alias("probability"), F.lit("unused").alias("other"),
    )
    tables.replace_table(rows, f"{schema}.scored")
    chosen = disclosure.initiatives(
        spark.table(f"{schema}.scored"), files.topic_dimension(spark), ["id"]
    ).select("organisation", "policy")
    plan = plan_of(chosen)
    assert "GreaterThan(probability,0.8)" in plan
    assert "unused" not in plan.split("ReadSchema")[1] and "other:" not in plan
    assert "BroadcastHashJoin" in plan and "WindowGroupLimit" in plan


def test_moving_an_external_table_keeps_its_partitions(spark, schema, numbers):
    path = fresh_path(spark, "external")
    numbers.write.partitionBy("part").parquet(path)
    tables.create_table(spark, f"{schema}.old", "id LONG, part INT", ["part"], path)
    spark.catalog.recoverPartitions(f"{schema}.old")
    tables.move_external(spark, f"{schema}.old", f"{schema}.new")
    assert not spark.catalog.tableExists(f"{schema}.old")
    assert spark.table(f"{schema}.new").select("part", "id").exceptAll(numbers).count() == 0
    assert spark.table(f"{schema}.new").count() == 100
    tables.register_files(spark, f"{schema}.new", path)


def _files_that_may_hold(spark, path, column, value):
    """Files whose least and greatest value admit ``value``."""
    name = F.input_file_name().alias("file")
    ranges = spark.read.parquet(path).select(name, column).groupBy("file")
    ranges = ranges.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return ranges.filter((F.col("low") <= F.lit(value)) & (F.col("high") >= F.lit(value))).count()


def test_a_reader_skips_files_by_each_of_several_columns(spark):
    rows = spark.range(0, 40000, 1, 4).select(
        "id",
        (F.col("id") * 7919 % 1000).alias("number"),
        F.concat(F.lit("key-"), F.lpad((F.col("id") * 104729 % 997).cast("string"), 4, "0")).alias("ticker"),
        F.timestamp_seconds(F.col("id") * 15485863 % 100000).cast("timestamp_ntz").alias("day"),
    )
    rows = rows.withColumn("number", F.when(F.col("id") % 50 != 0, F.col("number")))
    several, one = fresh_path(spark, "several"), fresh_path(spark, "one")
    files.replace_path(files.clustered_by(rows, ["number", "ticker"], ["id"], files=64), several)
    files.replace_path(files.clustered(rows, "number", ["id"], files=64), one)
    assert sorted(spark.read.parquet(several).collect()) == sorted(rows.collect())
    for column, value in (("number", 500), ("number", 3), ("ticker", "key-0500"), ("ticker", "key-0003")):
        assert _files_that_may_hold(spark, several, column, value) <= 20
    assert _files_that_may_hold(spark, one, "ticker", "key-0500") > 55
    third = fresh_path(spark, "third")
    files.replace_path(files.clustered_by(rows, ["day", "ticker", "number"], ["id"], files=64), third)
    day = rows.agg(F.expr("percentile_approx(id, 0.5)")).first()[0]
    value = rows.filter(F.col("id") == day).first()["day"]
    assert _files_that_may_hold(spark, third, "day", value) <= 32


def test_clustering_of_odd_tables(spark):
    same = spark.range(5000).select("id", F.lit("x").alias("a"), F.lit(None).cast("int").alias("b"))
    placed = files.clustered_by(same, ["a", "b"], ["id"], files=8)
    sizes = placed.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and placed.count() == 5000  # one value, several files
    assert files.clustered_by(same.limit(0), ["a", "b"], ["id"]).count() == 0
    with pytest.raises(ValueError):
        files.clustered_by(same, ["a"] * 8, ["id"], files=2)
