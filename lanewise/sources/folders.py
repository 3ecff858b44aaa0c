"""Looking at folders through Hadoop's file system, so any Spark storage works."""

import hashlib

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; empty when it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the Spark job that wrote ``path`` committed."""
    fs, target = _open(spark, f"{path}/_SUCCESS")
    return fs.exists(target)


def folder_bytes(spark: SparkSession, pattern: str) -> int:
    """Bytes of all files at or below the folders that ``pattern`` names."""
    fs, target = _open(spark, pattern)
    return sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(target) or [])


def version_stamp(spark: SparkSession, path: str) -> str:
    """A digest of name, length and time of every file at or below ``path``, to notice a
    rewritten table wherever the change is.  One listing, on the driver."""
    fs, target = _open(spark, path)
    found, files = [], fs.listFiles(target, True)
    while files.hasNext():
        status = files.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return hashlib.md5(repr(sorted(found)).encode()).hexdigest()


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)
