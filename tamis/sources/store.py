"""Small files and folders on whatever file system Spark uses for a path."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def put(spark: SparkSession, path: str, text: str = "") -> None:
    """Write a small file that appears whole or not at all."""
    files, where = _at(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f"_draft-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not files.rename(draft, where):
        files.delete(draft, False)
        raise FileExistsError(path)


def names(spark: SparkSession, path: str) -> dict[str, float]:
    """The entries of a folder with the seconds since they changed; none if it is absent."""
    files, where = _at(spark, path)
    if not files.exists(where):
        return {}
    now = spark._jvm.java.lang.System.currentTimeMillis()
    found = files.listStatus(where)
    return {f.getPath().getName(): (now - f.getModificationTime()) / 1000 for f in found}


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds, if it is there."""
    files, where = _at(spark, path)
    files.delete(where, True)
