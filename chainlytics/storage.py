"""Small path helpers that work on every file system Spark can reach, through the Hadoop API of Spark's own session."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    file_system, target = _path(spark, path)
    return file_system.exists(target)


def children(spark: SparkSession, path: str) -> set[str]:
    """Names directly under a folder."""
    file_system, target = _path(spark, path)
    return {entry.getPath().getName() for entry in file_system.listStatus(target)}


def drop(spark: SparkSession, path: str) -> None:
    file_system, target = _path(spark, path)
    file_system.delete(target, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder or file; ``to`` must not exist."""
    file_system, target = _path(spark, path)
    if not file_system.rename(target, _path(spark, to)[1]):
        raise OSError(f"cannot move {path} to {to}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Make ``text`` the content of a small file. It is there as a whole or not at all."""
    half = f"{path}.{uuid.uuid4().hex}"
    file_system, target = _path(spark, half)
    stream = file_system.create(target, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    drop(spark, path)
    move(spark, half, path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None where there is none."""
    file_system, target = _path(spark, path)
    if not file_system.exists(target):
        return None
    size = file_system.getFileStatus(target).getLen()
    stream = file_system.open(target)
    try:
        return bytes(stream.readNBytes(size)).decode("utf-8")
    finally:
        stream.close()
