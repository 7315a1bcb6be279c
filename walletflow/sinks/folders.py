"""Folders of the shared storage, through the file systems that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def make(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def touch(spark: SparkSession, path: str) -> None:
    """Write an empty file."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def remove(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; one operation where the file system has folders."""
    fs, p = _fs(spark, source)
    t = _fs(spark, target)[1]
    fs.mkdirs(t.getParent())
    if fs.exists(t) or not fs.rename(p, t):
        raise FileExistsError(f"{source} -> {target}")


def subfolders(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time in ms) of the folders in a folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), int(s.getModificationTime())) for s in fs.listStatus(p) if s.isDirectory()]
