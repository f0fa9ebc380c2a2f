"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a local session without one gets its own folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = _local_folders.get(context.applicationId)
    if folder is None:
        folder = _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="ringlake-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at its end, when whatever reads them has been written itself."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
            files.delete(hadoop_path, True)
            files.cancelDeleteOnExit(hadoop_path)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, empty folder below the shared one; Hadoop removes it when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/ringlake/{label}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop_path)  # only an existing path can be marked for removal
    files.deleteOnExit(hadoop_path)
    if _scopes:
        _scopes[-1].append(path)
    return path


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The same rows, read back from a written table.

    Cuts the lineage, so a lost executor re-reads files instead of recomputing, and
    gives the planner real sizes for later join choices.
    """
    path = new_folder(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
