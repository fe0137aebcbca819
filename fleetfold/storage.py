"""Folders on whatever file system the paths name. The only calls into Spark's JVM are here and need a classic session."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _on(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _on(spark, path)
    return fs.exists(folder)


def folders(spark: SparkSession, path: str) -> dict[str, str]:
    """Name and full path of what lies directly below a folder; nothing if it is not there."""
    fs, folder = _on(spark, path)
    if not fs.exists(folder):
        return {}
    return {s.getPath().getName(): s.getPath().toString() for s in fs.listStatus(folder)}


def drop_directory(spark: SparkSession, path: str) -> None:
    fs, folder = _on(spark, path)
    fs.delete(folder, True)


def make_directory(spark: SparkSession, path: str, until_exit: bool = False) -> None:
    fs, folder = _on(spark, path)
    fs.mkdirs(folder)
    if until_exit:
        fs.deleteOnExit(folder)


def create_file(spark: SparkSession, path: str) -> bool:
    """Make an empty file; tells whether it was not there before. Of several that try at once only one succeeds."""
    fs, file = _on(spark, path)
    fs.mkdirs(file.getParent())
    return fs.createNewFile(file)


def ages(spark: SparkSession, path: str) -> dict[str, float]:
    """Seconds since the last change of what lies directly below a folder."""
    fs, folder = _on(spark, path)
    if not fs.exists(folder):
        return {}
    return {s.getPath().getName(): time.time() - s.getModificationTime() / 1000 for s in fs.listStatus(folder)}


def hadoop_setting(spark: SparkSession, name: str, default: str) -> str:
    return spark.sparkContext._jsc.hadoopConfiguration().get(name, default)
