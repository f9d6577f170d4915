"""Intermediate tables that several later passes read.

A staged table is Parquet in the folder the cluster names in ``spark.checkpoint.dir``, so
it outlives lost executors and later passes read only the columns they need.
"""

from __future__ import annotations

import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


class _Scopes(threading.local):
    """Folders made inside each open scope of a thread and application, the innermost last."""

    def __init__(self):
        self.by_application: dict[str, list[list[str]]] = {}

    def of(self, spark: SparkSession) -> list[list[str]]:
        return self.by_application.setdefault(spark.sparkContext.applicationId, [])


_SCOPES = _Scopes()


def use_local_folder(spark: SparkSession) -> None:
    """Give a ``local`` session without a checkpoint folder one of its own, as tests do.

    A session of any other master, or one that has a folder, is left as it is.
    """
    context = spark.sparkContext
    if context.master.split("[")[0] == "local" and not _configured(spark):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="arrears-"))


def staging_root(spark: SparkSession) -> str:
    """The shared folder for staged tables, from the session's ``spark.checkpoint.dir``."""
    root = _configured(spark)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{root.rstrip('/')}/arrears-{spark.sparkContext.applicationId}"


def _configured(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession) -> str:
    """A fresh path in the shared folder."""
    path = f"{staging_root(spark)}/{uuid4().hex}"
    scopes = _SCOPES.of(spark)
    if scopes:
        scopes[-1].append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Removes what is staged inside the block at its end.

    For a step that has written its results by then. A query that returns a lazy frame
    cannot use one, as its caller still has to read what it staged.
    """
    _SCOPES.of(spark).append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        settings = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in _SCOPES.of(spark).pop():
            path = hadoop(folder)
            path.getFileSystem(settings).delete(path, True)


def keep(df: DataFrame) -> DataFrame:
    """Stage ``df`` outside of the innermost scope, so that it stays when that ends."""
    scopes = _SCOPES.of(df.sparkSession)
    inner = scopes.pop() if scopes else None
    try:
        return stage(df)
    finally:
        if inner is not None:
            scopes.append(inner)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
