"""Make this package importable in the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile

import claimscale
from pyspark.sql import SparkSession

# Rows are whole texts: ten thousand of them, Spark's usual batch, are tens of MB, held by the
# executor and its Python worker at once.
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20

_shipped: set[str] = set()


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches end at BATCH_BYTES, unless the session says how large they get."""
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))


def ship(spark: SparkSession) -> None:
    """Hand the package's sources to the executors, once per application, and bound batches.

    An installation on all machines makes this needless but not harmful.
    """
    bound_batches(spark)
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    top = os.path.dirname(os.path.abspath(claimscale.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="claimscale-"), "claimscale_sources.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.relpath(path, os.path.dirname(top)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
