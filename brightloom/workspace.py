"""Scratch tables in the folder the cluster shares, and the package for Python workers.

Intermediate results that several passes read are written there once, so a lost
executor costs a re-read of a table and never a recomputation of its lineage.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import weakref
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_roots: dict[str, str] = {}
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """The configured shared folder; a temporary one only for local sessions without it."""
    configured = spark.conf.get(SHARED_FOLDER, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    # a local-cluster has executors with folders of their own
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError(f"set {SHARED_FOLDER} to a folder every executor can reach")
    if context.applicationId not in _local_roots:
        path = tempfile.mkdtemp(prefix="brightloom-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _local_roots[context.applicationId] = path
    return _local_roots[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *, by: list[str] | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back; ``compression`` other than the session's.

    Shuffle files of the write go with it, and not only when the driver's memory is next collected.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.write.partitionBy(*by) if by else df.write
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        writer.parquet(path, compression=compression)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    # the schema is known, so no task has to open a file to infer it
    back = spark.read.schema(df.schema).parquet(path)
    _paths[back] = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` gave, once nothing reads them any more; other tables are left alone."""
    for table in tables:
        path = _paths.pop(table, None)
        if path is not None:
            spark = table.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def import_here(df: DataFrame) -> None:
    """Let Python workers of this machine find the package where the driver found it.

    A cluster gets the package by ``--py-files`` or installed; a path that is not there does no harm.
    """
    environment = df.sparkSession.sparkContext.environment
    root = str(Path(__file__).resolve().parents[1])
    paths = environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [root])
