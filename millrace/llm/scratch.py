"""The library's shared tables (``millrace.tables``), and what Python functions on texts need before they run."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.shipping import ship
from millrace.tables import drop, folder, owner, release, table

__all__ = ["drop", "folder", "owner", "partitions", "prepare", "release", "table"]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prepare(spark: SparkSession, rows: int = 512) -> None:
    """Before Python runs on texts: the package goes to the workers, and Arrow batches get few rows, for a batch is held whole."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    have = int(spark.conf.get(key))
    if have <= 0 or have > rows:
        spark.conf.set(key, str(rows))
