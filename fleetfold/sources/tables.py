"""Partitioned Parquet tables: writing, replacing partitions, versions, batches, retention.

A version or a batch is a directory of its own that counts once Spark has put its success marker
there. So a run that dies leaves nothing half-read, and running it again writes the same
directory anew.
"""

from __future__ import annotations

import contextlib
import re
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetfold.functions.time import instant
from fleetfold.storage import ages, create_file, drop_directory, folders, hadoop_setting, path_exists

# Rows per file, and how long live tables keep an order.
MAX_ROWS_PER_FILE = 100_000
RETENTION_HOURS = 24
FAN_IN = 8  # folds of one level that make one of the next
LEASE_HOURS = 24  # a lease that is older belongs to a reader that died


def require_markers(spark: SparkSession) -> None:
    """Without Spark's success markers nothing here would ever count as complete."""
    if hadoop_setting(spark, "mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").lower() == "false":
        raise RuntimeError("these tables need mapreduce.fileoutputcommitter.marksuccessfuljobs to be true")


def completed(spark: SparkSession, root: str, prefix: str) -> dict[int, str]:
    """Completed directories ``<prefix>=<n>`` below ``root`` by number."""
    found = {}
    for name, path in folders(spark, root).items():
        match = re.fullmatch(rf"{prefix}=(\d+)", name)
        if match and path_exists(spark, f"{path}/_SUCCESS"):
            found[int(match.group(1))] = path
    return dict(sorted(found.items()))


def write_partitioned(df: DataFrame, path: str, by: str, mode: str = "append", max_rows: int = MAX_ROWS_PER_FILE) -> None:
    """Write by partition column. The rebalance gathers a partition's rows in few tasks but lets
    adaptive execution split a partition that holds most of the data."""
    even = df.hint("rebalance", F.col(by))
    even.write.mode(mode).partitionBy(by).option("maxRecordsPerFile", max_rows).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: str, max_rows: int = MAX_ROWS_PER_FILE) -> None:
    """Replace exactly the partitions that ``df`` has rows for; running it twice changes nothing."""
    writer = df.hint("rebalance", F.col(by)).write.mode("overwrite").partitionBy(by)
    writer.option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_rows).parquet(path)


class ConcurrentChange(RuntimeError):
    """Another writer has published a version meanwhile."""


class VersionedTable:
    """A table as directories ``v=<n>``; readers see the newest completed one.

    The last few stay, and older ones as long as a reader holds a lease on them. A writer claims its number by creating a
    file, which only one can, so two writers never share a directory.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 3, lease_hours: float = LEASE_HOURS):
        require_markers(spark)
        self.spark, self.root, self.keep, self.lease_hours = spark, root, keep, lease_hours

    def versions(self) -> dict[int, str]:
        return completed(self.spark, self.root, "v")

    def newest(self) -> int:
        return max(self.versions(), default=0)

    def read(self) -> DataFrame | None:
        return self.at(self.newest())

    def at(self, number: int) -> DataFrame | None:
        """A given version; none is numbered 0."""
        return self.spark.read.parquet(f"{self.root}/v={number}") if number else None

    @contextlib.contextmanager
    def lease(self) -> Iterator[DataFrame | None]:
        """The newest version, which no writer drops inside the block. A lease that outlives its hours no longer holds."""
        while True:
            versions = self.versions()
            number = max(versions, default=0)
            if not number:
                yield None
                return
            held = f"{self.root}/leases/{number}-{uuid.uuid4().hex}"
            create_file(self.spark, held)
            if path_exists(self.spark, f"{versions[number]}/_SUCCESS"):
                break
            drop_directory(self.spark, held)  # dropped between the look and the lease
        try:
            yield self.spark.read.parquet(versions[number])
        finally:
            drop_directory(self.spark, held)

    def leased(self) -> set[int]:
        return {int(name.split("-")[0]) for name, age in ages(self.spark, f"{self.root}/leases").items() if age < 3600 * self.lease_hours}

    def _claim(self) -> int:
        """The next number that is free; a claim that has outlived a lease is that of a writer that died."""
        claims = f"{self.root}/claims"
        for name, age in ages(self.spark, claims).items():
            if age > 3600 * self.lease_hours:
                drop_directory(self.spark, f"{claims}/{name}")
        number = self.newest()
        while True:
            number += 1
            # Claims go when their write ends, so a number that is free may be complete by now.
            if create_file(self.spark, f"{claims}/{number}"):
                if number not in self.versions():
                    return number
                drop_directory(self.spark, f"{claims}/{number}")

    def write(
        self, df: DataFrame, max_rows: int = MAX_ROWS_PER_FILE, base: int | None = None, on_drop: Callable[[str], None] | None = None
    ) -> int:
        """Write the next version. With ``base`` it must still be the newest when the new one is published, else nothing is.

        ``on_drop`` is called with the folder of each version that is about to go.
        """
        number = self._claim()
        try:
            if base is not None and (self.newest() != base or number != base + 1):
                raise ConcurrentChange(f"{self.root} was at version {base}, now another writer is at work")
            df.write.mode("overwrite").option("maxRecordsPerFile", max_rows).parquet(f"{self.root}/v={number}")
        finally:
            drop_directory(self.spark, f"{self.root}/claims/{number}")
        leased = self.leased()
        for old, path in self.versions().items():
            if old <= number - self.keep and old not in leased:
                if on_drop is not None:
                    on_drop(path)
                drop_directory(self.spark, path)
        return number


def within_retention(ts: Column | str, as_of=None, hours: int = RETENTION_HOURS) -> Column:
    """Not older than the window. A row without a time stays, as its age is unknown."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts.isNull() | (ts >= instant(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS"))


class BatchTable:
    """A mutable keyed table fed by micro-batches, merged when read.

    Each micro-batch writes its own directory ``batch_id=<n>``, so its cost grows with the batch
    and not with the table, and a replay overwrites what it wrote. ``combine`` merges the rows of
    one key; as it is associative, batches can be folded: ``fold`` merges the loose batches into one directory
    ``fold=<level>.<first>-<last>`` of level 1, and ``FAN_IN`` folds of a level into one of the next. So a row is rewritten
    once per level, and the levels grow as the logarithm of the number of batches.

    With ``at``, a timestamp expression, directories are partitioned by its ``period`` (a day, unless a feed spans
    very many); retention then drops whole folders and rewrites nothing. With ``buckets``, a number from the key and a name
    for it, folders are parted by it too, and a read may open a few of them.
    """

    def __init__(
        self, spark: SparkSession, root: str, combine: Callable[[DataFrame], DataFrame] = lambda df: df,
        at: Column | None = None, period: str = "day", fan_in: int = FAN_IN, buckets: tuple[Column, str] | None = None,
    ):
        require_markers(spark)
        self.spark, self.root, self.combine, self.fan_in = spark, root, combine, fan_in
        self.at, self.period, self.buckets = at, period, buckets

    def _folds(self) -> list[tuple[int, int, int, str]]:
        """Completed folds as (level, first, last, path)."""
        out = []
        for name, path in folders(self.spark, self.root).items():
            match = re.fullmatch(r"fold=(\d+)\.(\d+)-(\d+)", name)
            if match and path_exists(self.spark, f"{path}/_SUCCESS"):
                out.append((*map(int, match.groups()), path))
        return sorted(out)

    def _live(self) -> tuple[list[tuple[int, int, int, str]], dict[int, str], list[str]]:
        """Folds and loose batches that count, and the paths that a higher fold has replaced."""
        folds = self._folds()

        def inside(level: int, first: int, last: int) -> bool:
            return any(high > level and a <= first and last <= b for high, a, b, _ in folds)

        batches = completed(self.spark, self.root, "batch_id")
        kept = [f for f in folds if not inside(*f[:3])]
        loose = {n: path for n, path in batches.items() if not inside(0, n, n)}
        replaced = [f[3] for f in folds if inside(*f[:3])] + [p for n, p in batches.items() if n not in loose]
        return kept, loose, replaced

    def contains(self, batch_id: int) -> bool:
        """The batch is part of a fold, so that its replay must change nothing."""
        return any(first <= batch_id <= last for _, first, last, _ in self._folds())

    def _write(self, rows: DataFrame, name: str) -> None:
        if not path_exists(self.spark, f"{self.root}/schema/_SUCCESS"):
            # Kept apart, as a directory may have no file left. Not derived from ``rows``, which may be observed.
            self.spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{self.root}/schema")
        if self.at is None:
            rows.write.mode("overwrite").parquet(f"{self.root}/{name}")
        else:
            dated = rows.withColumn("_from", F.to_date(F.date_trunc(self.period, self.at)))
            parts = ["_from"]
            if self.buckets is not None:
                parts.append(self.buckets[1])
                dated = dated.withColumn(self.buckets[1], self.buckets[0])
            even = dated.hint("rebalance", *[F.col(c) for c in parts])
            even.write.mode("overwrite").partitionBy(*parts).option("maxRecordsPerFile", MAX_ROWS_PER_FILE).parquet(f"{self.root}/{name}")

    def _read(self, paths: list[str], where: Column | None = None) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.root}/schema").schema
        if self.at is None:
            return self.spark.read.schema(schema).parquet(*paths)
        stored = "" if self.buckets is None else f", {self.buckets[1]} int"
        parts = StructType([*schema.fields, *StructType.fromDDL(f"_from date{stored}").fields])
        frames = [self.spark.read.schema(parts).parquet(p) for p in paths]
        return reduce(DataFrame.unionByName, [(df if where is None else df.where(where)).select(*schema.names) for df in frames])

    def put(self, rows: DataFrame, batch_id: int) -> bool:
        """Write a batch, or nothing if it is folded already; tells whether it was written."""
        if self.contains(batch_id):
            return False
        self._write(rows, f"batch_id={batch_id}")
        return True

    def read(self, upto: int | None = None, where: Column | None = None) -> DataFrame | None:
        """Current rows, one per key; ``upto`` leaves later batches out, ``where`` folders by their date ``_from`` and bucket."""
        folds, loose, _ = self._live()
        paths = [f[3] for f in folds] + [p for n, p in loose.items() if upto is None or n <= upto]
        return self.combine(self._read(paths, where)) if paths else None

    def fold(self, batch_id: int) -> None:
        """Fold the loose batches up to ``batch_id``, and then folds of one level wherever there are enough."""
        folds, loose, replaced = self._live()
        due = {n: path for n, path in loose.items() if n <= batch_id}
        if due:
            self._write(self.combine(self._read(list(due.values()))), f"fold=1.{min(due)}-{max(batch_id, *due)}")
        level = 1
        while len(same := [f for f in self._live()[0] if f[0] == level]) >= self.fan_in:
            rows = self.combine(self._read([f[3] for f in same]))
            self._write(rows, f"fold={level + 1}.{min(f[1] for f in same)}-{max(f[2] for f in same)}")
            level += 1
        for path in replaced:  # by earlier folds, so that running readers could finish
            drop_directory(self.spark, path)

    def drop_before(self, cutoff: Column) -> int:
        """Drop the folders of periods that lie wholly before ``cutoff``; returns their number. Undated rows stay."""
        first_kept = self.spark.range(1).select(F.date_format(F.date_trunc(self.period, cutoff), "yyyy-MM-dd")).first()[0]
        dropped = 0
        for root in [f[3] for f in self._folds()] + list(completed(self.spark, self.root, "batch_id").values()):
            for name, path in folders(self.spark, root).items():
                match = re.fullmatch(r"_from=(\d{4}-\d{2}-\d{2})", name)
                if match and match.group(1) < first_kept:
                    drop_directory(self.spark, path)
                    dropped += 1
        return dropped
