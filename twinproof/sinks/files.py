"""Paths on whatever file system they name."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _open(spark, path)
    return fs.exists(at)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below."""
    at, fs = _open(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _open(spark, path)
    fs.delete(at, True)


def move_files(spark: SparkSession, source: str, target: str, prefix: str) -> None:
    """Move the data files of one folder into another as ``prefix-...``, in place of all files of that prefix there."""
    at, fs = _open(spark, source)
    to, _ = _open(spark, target)
    fs.mkdirs(to)
    for old in fs.listStatus(to):
        if old.getPath().getName().startswith(f"{prefix}-"):
            fs.delete(old.getPath(), False)
    for new in fs.listStatus(at):
        name = new.getPath().getName()
        if not name.startswith(("_", ".")) and not fs.rename(new.getPath(), spark._jvm.org.apache.hadoop.fs.Path(to, f"{prefix}-{name}")):
            raise OSError(f"{name} could not be moved to {target}")
