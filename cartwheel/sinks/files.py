"""Folders of a file system as Spark sees them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """File system and path object of ``path``."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    files, where = hadoop_path(spark, path)
    return files.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder, sorted; none if it is not there."""
    files, where = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of everything below a folder."""
    files, where = hadoop_path(spark, path)
    return files.getContentSummary(where).getLength() if files.exists(where) else 0


def delete(spark: SparkSession, path: str) -> None:
    files, where = hadoop_path(spark, path)
    files.delete(where, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file; the folders above it are made."""
    files, where = hadoop_path(spark, path)
    files.create(where, True).close()
