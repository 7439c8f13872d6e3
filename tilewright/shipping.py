"""Makes the package importable in Python workers, wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's sources to the executors, once for each Spark application (they are served
    by the driver, as with spark-submit --py-files)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tilewright-"), "tilewright.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for n in sorted(names):
                if n.endswith(".py"):
                    at = os.path.join(folder, n)
                    z.write(at, os.path.join("tilewright", os.path.relpath(at, root)))
    context.addPyFile(path)
