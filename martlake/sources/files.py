"""The few things to do with files that readers and writers of tables do not offer."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file in one step; False if there is one of that name, which is left alone."""
    files, target = _open(spark, path)
    try:
        out = files.create(target, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName() or files.exists(target):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def delete(spark: SparkSession, path: str) -> None:
    files, target = _open(spark, path)
    files.delete(target, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    files, target = _open(spark, path)
    return files.getContentSummary(target).getLength()


def leaf_folders(spark: SparkSession, path: str) -> list[str]:
    """Partition folders of a written table, down to those that hold files; one entry per partition."""
    files, target = _open(spark, path)
    found = [s for s in files.listStatus(target) if s.isDirectory() and "=" in s.getPath().getName()]
    if not found:
        return [path]
    return sorted(leaf for s in found for leaf in leaf_folders(spark, f"{path}/{s.getPath().getName()}"))
