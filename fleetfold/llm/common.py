"""Helpers that the text operators share."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold.session import pin, tune

BATCH_ROWS = 500  # rows per Arrow batch: bounds what a Python worker, and the JVM beside it, hold at a time
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@functools.cache
def _ship(application: str) -> None:
    """Send this package to the Python workers, wherever the driver was started from."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = os.path.join(tempfile.mkdtemp(), "fleetfold.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(os.path.join(root, "fleetfold")):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    out.write(path, os.path.relpath(path, root))
    SparkSession.active().sparkContext.addPyFile(archive)


def ready(spark: SparkSession) -> SparkSession:
    """Settings that the operators count on, and the package on the workers' path."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    _ship(spark.sparkContext.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table of the test data."""
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; a null key counts as remainder 0."""
    return F.coalesce(F.crc32(key.cast("string")) % divisor, F.lit(0))


def row_key(id_column: Column, text: Column) -> Column:
    """Tells rows apart that are not exact repeats of each other, also where ids repeat or are null."""
    return F.struct(id_column.alias("id"), F.xxhash64(text).alias("hash"), F.length(text).alias("length"))


def pinned_small(df: DataFrame, name: str, most_rows: int) -> tuple[DataFrame, bool]:
    """A pinned copy, and whether it has few enough rows to be sent to every task."""
    copy = pin(df, name)
    return copy, copy.count() <= most_rows
