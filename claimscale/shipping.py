"""Make this package importable in the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's sources to the executors, once per application.

    An installation on all machines makes this needless but not harmful.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="claimscale-"), "claimscale_library.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.relpath(path, os.path.dirname(top)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
