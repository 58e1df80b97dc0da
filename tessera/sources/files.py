"""Files of the session's stores, as Python tasks and the driver's control plane see them."""

from __future__ import annotations

import pyarrow.fs
from pyspark.sql import SparkSession


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """Arrow's file system for a path or URI (local, HDFS, S3, GCS), and the path in it."""
    scheme = path.partition(":")[0]
    if scheme in ("s3a", "s3n"):
        return pyarrow.fs.FileSystem.from_uri("s3" + path[len(scheme):])
    if scheme == "file":
        return pyarrow.fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        return pyarrow.fs.FileSystem.from_uri(path)
    return pyarrow.fs.LocalFileSystem(), path


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the session's Hadoop configuration, for the driver."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark names files below it: absolute, with scheme and authority."""
    fs, jpath = hadoop_path(spark, path)
    return fs.makeQualified(jpath).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.exists(jpath)


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = hadoop_path(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, jpath = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []
