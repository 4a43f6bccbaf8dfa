"""Tables between steps, in the folder that all executors and the driver share.

The folder is the session's ``spark.checkpoint.dir``; where that is unset a temporary one
is made and set, on a local master only: on a cluster that is an error, as executors don't
share the driver's folders.  A step that is read more than once is written here as Parquet,
so a lost executor costs the tasks it ran and never the steps before them.  ``release``
drops what a session, or one ``owner`` in it, has written.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, list[str]] = {}
_owner: ContextVar[str] = ContextVar("owner", default="")


@contextmanager
def owner(name: str) -> Iterator[None]:
    """Tables written inside belong to `name`."""
    was = _owner.set(name)
    try:
        yield
    finally:
        _owner.reset(was)


def folder(spark: SparkSession) -> str:
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def table(df: DataFrame, name: str) -> DataFrame:
    """`df`, computed once and read back from the shared folder."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{_owner.get()}{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    key = spark.sparkContext.applicationId
    if key not in _written:
        _written[key] = []
        atexit.register(_at_exit, spark, key)
    _written[key].append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete a table that `table` returned, once nothing will read it any more."""
    spark = df.sparkSession
    mine = _written.get(spark.sparkContext.applicationId, [])
    for file in df.inputFiles()[:1]:
        for path in [p for p in mine if p.rsplit("/", 1)[-1] in file]:
            _remove(spark, path)
            mine.remove(path)


def release(spark: SparkSession, keep: DataFrame | None = None, of: str = "") -> None:
    """Delete all tables this session (or an owner `of` it) wrote here but those that `keep` reads: call it when their readers are done."""
    mine = _written.get(spark.sparkContext.applicationId, [])
    used = keep.inputFiles() if keep is not None and mine else []
    for path in list(mine):
        name = path.rsplit("/", 1)[-1]
        if name.startswith(of) and not any(name in file for file in used):
            _remove(spark, path)
            mine.remove(path)


def _at_exit(spark: SparkSession, key: str) -> None:
    if _written.get(key) and spark.sparkContext._jsc is not None:
        release(spark)
