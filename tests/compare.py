"""Run a named query and its SQL side by side and compare columns, row count and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else repr(value + 0.0))
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, dt.datetime):
        return ("datetime", value.isoformat())
    return (type(value).__name__, str(value))


def differences(spark: SparkSession, con, query, sql: str, sf_dir: str) -> list[str]:
    got = query(spark, sf_dir)
    table = got.toArrow()
    expected = con.sql(sql).to_arrow_table()
    names = sorted(got.columns)
    if names != sorted(expected.column_names):
        return [f"columns {sorted(set(names) ^ set(expected.column_names))}"]

    def rows(arrow) -> list[tuple]:
        columns = [arrow.column(n).to_pylist() for n in names]
        return sorted((tuple(plain(v) for v in row) for row in zip(*columns)), key=repr)

    a, b = rows(table), rows(expected)
    if len(a) != len(b):
        return [f"rows {len(a)} != {len(b)}"]
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    out = [f"{len(bad)} of {len(a)} rows differ"] if bad else []
    for x, y in bad[:2]:
        out.append("; ".join(f"{n}: {p} != {q}" for n, p, q in zip(names, x, y) if p != q))
    if not a:
        out.append("no rows")
    return out
