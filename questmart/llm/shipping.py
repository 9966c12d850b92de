"""Makes this package importable in Python workers, wherever the driver was started."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import questmart


@functools.cache
def _shipped(application: str, spark: SparkSession) -> None:
    root = os.path.dirname(os.path.abspath(questmart.__file__))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="questmart-ship-"))
    path = os.path.join(folder, "questmart.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for base, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    # Spark sends the file to every executor.
    spark.sparkContext.addPyFile(path)


def ship_package(spark: SparkSession) -> None:
    """Sends the package's sources to the workers, once per application."""
    _shipped(spark.sparkContext.applicationId, spark)
