"""Sends this package to the workers, so that functions in Python run wherever a session runs."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once an application; Spark serves it to all executors."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _sent.add(context.applicationId)
