"""Epoch folders of a streaming table, with a commit mark of their own.

A folder counts once its mark exists.  The mark is a file written after all
folders of the epoch, so an epoch is visible whole or not at all, whatever
committer wrote the data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def mark(spark: SparkSession, table_dir: str, name: str, number: int) -> None:
    """Commit ``<name>=<number>`` of the table."""
    p, fs = _fs(spark, f"{table_dir.rstrip('/')}/_commits/{name}={number:09d}")
    fs.create(p, True).close()


def marked(spark: SparkSession, table_dir: str, name: str) -> list[int]:
    """The committed numbers, in order."""
    p, fs = _fs(spark, f"{table_dir.rstrip('/')}/_commits/{name}=*")
    return sorted(int(f.getPath().getName().rsplit("=", 1)[1]) for f in fs.globStatus(p) or [])


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)
