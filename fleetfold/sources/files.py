"""Readers of the event feeds and dimension files, and the bronze writer."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetfold.storage import path_exists


def wait_for_path(spark: SparkSession, path: str, poll_seconds: float = 5.0, timeout_seconds: float | None = None) -> bool:
    """Wait until a feed's folder appears; false when the time is up."""
    start = time.monotonic()
    while not path_exists(spark, path):
        if timeout_seconds is not None and time.monotonic() - start >= timeout_seconds:
            return False
        time.sleep(poll_seconds)
    return True


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header CSV with declared types; a value that does not fit its type becomes null."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with a declared schema; the ingest date of the directory is not part of it."""
    return spark.read.schema(schema).json(path).select(*schema.names)


def stream_json(
    spark: SparkSession, path: str, schema: StructType, max_files: int = 1000, archive_to: str | None = None
) -> DataFrame:
    """Streaming source over JSON-lines files, ``max_files`` per micro-batch.

    Consumed files stay where they are, since other streams read them too, unless ``archive_to``
    names a folder to move them to. The ``dt=`` directory column is left out.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if archive_to is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_to)
    return reader.json(path).select(*schema.names)


def write_bronze(df: DataFrame, path: str, ingest_date=None) -> None:
    """JSON lines below ``dt=yyyy-MM-dd``; without a date given, that of today."""
    dated = df.withColumn("dt", F.date_format(F.current_date() if ingest_date is None else ingest_date, "yyyy-MM-dd"))
    dated.hint("rebalance", F.col("dt")).write.mode("append").partitionBy("dt").json(path)


def read_partition(spark: SparkSession, path: str, column: str, first, last=None) -> DataFrame:
    """The partitions ``first`` to ``last`` of a partitioned Parquet table; Catalyst prunes the rest."""
    return spark.read.parquet(path).where(F.col(column).between(F.lit(first), F.lit(first if last is None else last)))


def read_partitions_by_glob(spark: SparkSession, path: str, column: str) -> DataFrame:
    """All partitions by pattern, for a folder whose other content is to be passed over."""
    return spark.read.option("basePath", path).parquet(f"{path}/{column}=*")
