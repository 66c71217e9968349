"""Sends this package to the executors, so that Python operators need no installation there."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        top = Path(__file__).parent
        path = os.path.join(tempfile.mkdtemp(prefix="tidelog-code-"), "tidelog.zip")
        with zipfile.ZipFile(path, "w") as out:
            for source in sorted(top.rglob("*.py")):
                out.write(source, source.relative_to(top.parent))
        spark.sparkContext.addPyFile(path)
    return spark
