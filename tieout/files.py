"""Small files beside the tables, through the file system that a path's scheme names.

Used by the driver only, for markers of a few bytes; tables go through Spark's writers.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Create a file; False if it exists already. On file systems that create atomically, one of many callers wins."""
    fs, where = _at(spark, path)
    try:
        out = fs.create(where, False)
    except Py4JJavaError:
        if fs.exists(where):
            return False
        raise
    out.write(bytearray(content.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file; empty if it is being written."""
    fs, where = _at(spark, path)
    size = fs.getFileStatus(where).getLen()
    if not size:
        return ""
    stream = fs.open(where)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder in ascending order; none if there is no such folder."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(where))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    fs, where = _at(spark, path)
    fs.delete(where, True)
