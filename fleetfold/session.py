"""Session settings and the shared working folder."""

from __future__ import annotations

import contextlib
import functools
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from fleetfold.storage import drop_directory, make_directory

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split even where that costs one more shuffle behind the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator here counts on."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "fleetfold", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    partitions = str(os.cpu_count() if cores == "*" else cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", _local_base())
        # Call sites in error messages cost several calls into the JVM per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="fleetfold-")


def shared_base(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session, or the
    checkpoint folder its context was given.

    Where neither is set a local session, whose executors are the driver, gets one private folder per process and
    keeps it in the setting; a cluster has to name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_base()


@functools.cache
def _run_folder(spark: SparkSession, base: str) -> str:
    """One folder per application below the shared one; the file system drops it when the driver ends."""
    folder = f"{base}/fleetfold/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    make_directory(spark, folder, until_exit=True)
    return folder


_SCOPES = threading.local()


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Drop everything this thread pins inside the block at its end. What is computed from it must be written by then."""
    held = getattr(_SCOPES, "folders", [])
    folder = f"{_run_folder(spark, shared_base(spark))}/scope-{uuid.uuid4().hex}"
    _SCOPES.folders = [*held, folder]
    try:
        yield folder
    finally:
        _SCOPES.folders = held
        drop_directory(spark, folder)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, readable by all executors until the scope or the driver ends."""
    scopes = getattr(_SCOPES, "folders", [])
    folder = scopes[-1] if scopes else _run_folder(spark, shared_base(spark))
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so that later steps see one fixed set of rows.

    The copy lies in the shared folder as Parquet: it survives lost executors, cuts the lineage
    and is read column by column.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
