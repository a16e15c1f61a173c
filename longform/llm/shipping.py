"""Make this package importable in the Python workers of a cluster, with batches they can hold."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import longform

_shipped: dict[str, str] = {}
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors once per application (they are not installed there).

    Batches sent to Python are held to 8 MB unless the session says otherwise: a worker holds
    several copies of one, and rows may be long. No result depends on it.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, "8m")
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(longform.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="longform-package-"), "longform_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped[context.applicationId] = archive
