"""The few file-system calls Spark's readers and writers do not offer."""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _handle(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _handle(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def touch(spark: SparkSession, path: str) -> None:
    fs, target = _handle(spark, path)
    fs.create(target, False).close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False if it does.

    Of several writers one succeeds, where the file system's create is atomic.
    The file is empty for the moment between its creation and its closing.
    """
    fs, target = _handle(spark, path)
    try:
        stream = fs.create(target, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """All of a small file."""
    fs, target = _handle(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def age_seconds(spark: SparkSession, path: str) -> float:
    """Time since the last write."""
    fs, target = _handle(spark, path)
    return time.time() - fs.getFileStatus(target).getModificationTime() / 1000


def file_marks(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """Path, size and time of the last write of each file that a path or pattern names, folders' files included."""
    fs, target = _handle(spark, pattern)
    found, open_ = [], list(fs.globStatus(target) or [])
    while open_:
        status = open_.pop()
        name = status.getPath().getName()
        if status.isDirectory():
            open_ += fs.listStatus(status.getPath())
        elif not name.startswith(("_", ".")):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _handle(spark, path)
    fs.delete(target, True)


def rename(spark: SparkSession, path: str, target: str) -> None:
    fs, source = _handle(spark, path)
    if not fs.rename(source, _handle(spark, target)[1]):
        raise RuntimeError(f"{path} could not be renamed to {target}")
