"""Intermediate results that are computed once and read several times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from claimscale.session import shared_folder

FILES_PER_CORE = 4  # of a table of numbers
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_folder(spark: SparkSession) -> str:
    """Folder of everything this application stages."""
    return f"{shared_folder(spark)}/claimscale/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{stage_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_stages(spark: SparkSession) -> None:
    """Delete what this application staged, once no DataFrame reads it any more."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(stage_folder(spark))
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    folder.getFileSystem(configuration).delete(folder, True)


def discard(spark: SparkSession, path: str) -> None:
    """Delete one staged table that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage_and_free(df: DataFrame, path: str) -> DataFrame:
    """``stage`` at a given path; Spark deletes the step's shuffle files once it is written.

    Else they stay until the driver happens to collect its garbage, beside those of the
    steps that follow.
    """
    spark = df.sparkSession
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    This cuts the lineage in a way that outlives lost executors, keeps columnar
    pruning for the readers, and freezes values: floating-point sums may differ
    in the last digit between two evaluations of one plan, so whatever is ranked
    and counted has to be read from one evaluation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_few(df: DataFrame, label: str = "stage", run=None) -> DataFrame:
    """``stage`` for rows of a few numbers: some tasks per core, not one per shuffle partition.

    Hadoop's local file system starts processes for each file that it makes, and a written
    file of some rows costs more than they do.  ``run`` is a step on Arrow batches that
    keeps the schema; it runs in the tasks that write.
    """
    few = df.coalesce(FILES_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)
    return stage(few.mapInArrow(run, df.schema) if run else few, label)
