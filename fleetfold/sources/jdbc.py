"""JDBC staging and append. The work stays in Spark; a database is only a place to put results."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def secret(name: str, folders: tuple[str, ...] = ("/run/secrets",), default: str | None = None) -> str | None:
    """A secret from the first folder that has it (plain or ``.txt``), else from the environment."""
    for folder in folders:
        for file in (Path(folder) / name, Path(folder) / f"{name}.txt"):
            if file.is_file():
                return file.read_text().strip()
    return os.environ.get(name.upper(), default)


def postgres_url(host: str, port: int | str, database: str) -> str:
    """Untyped strings let the server cast them to the column's type."""
    return f"jdbc:postgresql://{host}:{port}/{database}?stringtype=unspecified"


def jdbc_options(url: str, table: str, **extra: str | None) -> dict[str, str]:
    driver = {"jdbc:postgresql:": "org.postgresql.Driver"}.get(":".join(url.split(":")[:2]) + ":")
    options = {"url": url, "dbtable": table, "driver": driver, **extra}
    return {name: str(value) for name, value in options.items() if value is not None}


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Give ``partitionColumn``, its bounds and ``numPartitions`` to read a large table in parallel."""
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, options: dict[str, str], mode: str = "overwrite") -> None:
    """``overwrite`` replaces a staging table, ``append`` adds to a log."""
    df.write.format("jdbc").options(**options).mode(mode).save()
