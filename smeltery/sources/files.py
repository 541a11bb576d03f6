"""Small files beside a table, through Hadoop's file systems: any store that Spark reads will do.

Nothing here starts a Spark job. The session's own settings hold, as for the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a directory, sorted; none if it is missing."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(where))


def read(spark: SparkSession, path: str) -> bytes | None:
    """The bytes of a file, None if it is missing."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def write(spark: SparkSession, path: str, data: bytes, replace: bool = False) -> bool:
    """Write a file that appears whole or not at all; False if it exists and is not to be replaced."""
    fs, where = _at(spark, path)
    if not replace and fs.exists(where):
        return False
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rpartition('/')[0]}/_{uuid.uuid4()}")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    if replace:
        fs.delete(where, False)
    if not fs.rename(beside, where):
        fs.delete(beside, False)
        return False
    return True


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def total_length(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a directory, 0 if it is missing."""
    fs, where = _at(spark, path)
    return fs.getContentSummary(where).getLength() if fs.exists(where) else 0
