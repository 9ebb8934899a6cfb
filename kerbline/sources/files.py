"""The few file-system calls the tables need, through the session's own Hadoop client,
so that paths on HDFS, object stores and local disks all work."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return fs.exists(target)


def make_directory(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.mkdirs(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _at(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _at(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _at(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
