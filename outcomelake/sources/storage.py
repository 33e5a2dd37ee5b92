"""The few file operations that a lake needs beside reading and writing tables, on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def children(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder with their modification times in milliseconds; none if it is absent."""
    system, folder = _open(spark, path)
    if not system.exists(folder):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in system.listStatus(folder)}


def move(spark: SparkSession, path: str, target: str) -> None:
    system, source = _open(spark, path)
    _, destination = _open(spark, target)
    system.mkdirs(destination.getParent())
    if not system.rename(source, destination):
        raise OSError(f"cannot move {path} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    system, folder = _open(spark, path)
    system.delete(folder, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text in a file, in place of what it held."""
    system, file = _open(spark, path)
    out = system.create(file, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
