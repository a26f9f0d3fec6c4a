"""Intermediate tables in the cluster's shared folder.

A customer-level frame that feeds several later steps is written once as Parquet and
read back: lineage is cut, lost executors cost nothing, later steps read only the columns
they need, and the planner knows the real size when it decides on broadcasts."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator

from pyspark.sql import DataFrame, SparkSession, types as T

_local_dirs: dict[str, str] = {}
_kept: dict[tuple[str, Hashable], tuple[str, T.StructType]] = {}
_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, a cluster is an error, and
    local mode, whose only machine shares all its folders, gets one of its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="patronlens-")
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/patronlens/{app}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and continue from the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, also after a failure."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, location: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def source_version(spark: SparkSession, folder: str) -> tuple:
    """Name, length and time of change of what a folder holds, one level into its tables: a
    key that changes with the tables."""
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(context._jsc.hadoopConfiguration())
    found = []
    for entry in files.listStatus(root):
        parts = files.listStatus(entry.getPath()) if entry.isDirectory() else [entry]
        found += [(p.getPath().toString(), p.getLen(), p.getModificationTime()) for p in parts]
    return tuple(sorted(found))


def stage_once(spark: SparkSession, key: Hashable, label: str,
               build: Callable[[], DataFrame]) -> DataFrame:
    """Like `stage`, but one table per application and key: reports that stand on the
    same history share it, the way they would share a stored table."""
    slot = (spark.sparkContext.applicationId, key)
    if slot not in _kept:
        df = build()
        path = new_path(spark, label)
        df.write.parquet(path)
        _kept[slot] = (path, df.schema)
    path, schema = _kept[slot]
    return spark.read.schema(schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Drop the memory of shared tables (their files stay until `release`)."""
    app = spark.sparkContext.applicationId
    for slot in [s for s in _kept if s[0] == app]:
        del _kept[slot]


def release(spark: SparkSession) -> None:
    """Delete every staged table of this application. Call when no frame is in use."""
    forget(spark)
    _delete(spark, f"{shared_dir(spark)}/patronlens/{spark.sparkContext.applicationId}")
