"""Many small files of a partitioned Parquet table as few large ones, while a stream goes on writing the table.

What has been compacted is told by a manifest, a versioned table with one row per file: the source files that are covered,
and the data files that hold their rows now. One version of it is one state of the whole, so whoever reads takes one version
and derives everything from it: the data files to open, and, against one listing of the source, the files not covered yet.
A run that ends meanwhile cannot be seen in part.

A run takes the new files of a partition together with the partition's data files that are not full, and writes them as
files of up to ``max_rows``; so however many runs there were, a partition has the files that its size asks for, and a run
rewrites less than one full file of a partition beside what is new. Files are listed, never scanned, to know them.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold.session import pin
from fleetfold.sources.tables import MAX_ROWS_PER_FILE, VersionedTable, completed, write_partitioned
from fleetfold.storage import drop_directory, path_exists

MAX_NAMED_FILES = 10_000  # files that a read names one by one
FULL_BYTES = 64 << 20  # a file of this size is full, whatever its rows
_GLOB = re.compile(r"[*?\[\]{}\\,]")  # signs that would not be taken as they are in a path


class CompactedTable:
    """A partitioned Parquet table that is written by others, and its compacted copy below ``target``.

    The source is read through the log of the stream that writes it, if it has one, and is never changed. A run that dies
    publishes nothing and is done again. Of two runs at once the second to end gives up (``ConcurrentChange``).
    """

    def __init__(self, spark: SparkSession, source: str, target: str, by: str):
        self.spark, self.source, self.target, self.by = spark, source, target, by
        # The last few versions stay, and with them the files they name, for readers that are at work.
        self.manifest = VersionedTable(spark, f"{target}/manifest")

    def _listing(self, path: str) -> DataFrame:
        """Files of a table with their partition and size, from the file system or the log of a stream."""
        listed = self.spark.read.format("binaryFile").load(path)
        return listed.select(
            F.col(self.by), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("path").alias("file"), F.col("length").alias("bytes")
        )

    def _source_files(self, where: Column | None) -> DataFrame:
        files = self._listing(self.source)
        return files if where is None else files.where(where)  # prunes folders

    def _not_covered(self, files: DataFrame, manifest: DataFrame | None) -> DataFrame:
        if manifest is None:
            return files
        covered = manifest.where("kind = 'source'").select(F.col(self.by).alias("_by"), F.col("name").alias("_name"))
        return files.join(covered, (F.col("name") == F.col("_name")) & F.col(self.by).eqNullSafe(F.col("_by")), "left_anti")

    def _open(self, files: DataFrame, base: str, schema, where: Column | None) -> DataFrame | None:
        """Rows of the given files below ``base``. A few files are opened by name, many are found by a join."""
        few = files.select("file").limit(MAX_NAMED_FILES + 1).collect()
        if not few:
            return None
        reader = self.spark.read.schema(schema)
        if len(few) <= MAX_NAMED_FILES and not any(_GLOB.search(r.file) for r in few):
            return reader.option("basePath", base).parquet(*[r.file for r in few])
        rows = reader.parquet(base)
        rows = rows if where is None else rows.where(where)
        named = rows.withColumns({"_name": F.col("_metadata.file_name"), "_by": F.col(self.by)})
        wanted = files.select(F.col("name").alias("_n"), F.col(self.by).alias("_b"))
        return named.join(wanted, (F.col("_name") == F.col("_n")) & F.col("_by").eqNullSafe(F.col("_b")), "left_semi").drop("_name", "_by")

    def _rows_of(self, files: DataFrame, schema=None, where: Column | None = None) -> DataFrame | None:
        """Source rows of the given files."""
        return self._open(files, self.source, schema or self.spark.read.parquet(self.source).schema, where)

    def _data_of(self, files: DataFrame, schema, where: Column | None = None) -> DataFrame | None:
        """Compacted rows of the given files; each run has a folder of its own below ``data``."""
        rows = self._open(files, f"{self.target}/data", schema, where)
        return None if rows is None else rows.select(*schema.names)

    def read(self, where: Column | None = None) -> DataFrame:
        """All rows once: the compacted ones, and those of files that are not covered yet.

        ``where`` is a condition on the partition column; files of other partitions are neither listed nor opened.
        """
        schema = self.spark.read.parquet(self.source).schema
        manifest = self.manifest.read()
        parts = []
        if manifest is not None:
            data = manifest.where("kind = 'data'")
            parts.append(self._data_of(data if where is None else data.where(where), schema, where))
        new = self._not_covered(self._source_files(where), manifest)
        parts.append(self._rows_of(pin(new, "new-files") if manifest is not None else new, schema, where))
        found = [p for p in parts if p is not None]
        rows = reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], schema)
        return rows if where is None else rows.where(where)

    def compact(self, max_rows: int = MAX_ROWS_PER_FILE, full_bytes: int = FULL_BYTES) -> int:
        """Take in all files that are not covered yet; returns their number."""
        if not path_exists(self.spark, self.source):
            return 0
        base = self.manifest.newest()
        manifest = self.manifest.at(base)
        new = pin(self._not_covered(self._source_files(None), manifest), "new-files")
        count = new.count()
        if not count:
            return 0
        rows, none = self._rows_of(new), F.lit(None).cast("long")
        schema = rows.schema
        entries = new.select(F.lit("source").alias("kind"), self.by, "name", "file", "bytes", none.alias("rows"))
        if manifest is not None:
            touched = new.select(F.col(self.by).alias("_by")).distinct()
            small = (F.col("kind") == "data") & (F.col("rows") * 2 < max_rows) & (F.col("bytes") < full_bytes)
            merged = pin(manifest.where(small).join(touched, F.col(self.by).eqNullSafe(F.col("_by")), "left_semi"), "small-files")
            again = self._data_of(merged, schema)
            rows = rows if again is None else rows.unionByName(again)
            gone = merged.select("kind", F.col("file").alias("_file"))
            entries = entries.unionByName(manifest.join(gone, (manifest["kind"] == gone["kind"]) & (F.col("file") == F.col("_file")), "left_anti"))
        run = f"{self.target}/data/run={uuid.uuid4().hex}"
        write_partitioned(rows, run, self.by, "overwrite", max_rows)
        try:
            self.manifest.write(entries.unionByName(self._written(run, schema)), base=base, on_drop=self._drop_files)
        except Exception:
            drop_directory(self.spark, run)
            raise
        return count

    def _written(self, run: str, schema) -> DataFrame:
        """Manifest rows of the files of a run; their rows are counted without reading a column."""
        held = self.spark.read.schema(schema).parquet(run)
        counts = held.groupBy(F.col(self.by).alias("_by"), F.col("_metadata.file_name").alias("_name")).agg(F.count(F.lit(1)).alias("rows"))
        files = self._listing(run).withColumn(self.by, F.col(self.by).cast(schema[self.by].dataType))
        same = (F.col("name") == F.col("_name")) & F.col(self.by).eqNullSafe(F.col("_by"))
        return files.join(counts, same).select(F.lit("data").alias("kind"), self.by, "name", "file", "bytes", "rows")

    def _drop_files(self, old: str) -> None:
        """Delete the data files that only a version before those kept has named."""
        number = int(old.rsplit("=", 1)[1])
        others = [path for n, path in completed(self.spark, self.manifest.root, "v").items() if n != number]
        own, kept = (self.spark.read.parquet(*p).where("kind = 'data'").select("file") for p in ([old], others))
        for row in own.join(kept.distinct(), "file", "left_anti").toLocalIterator():
            drop_directory(self.spark, row.file)


def compact(spark: SparkSession, source: str, target: str, by: str, max_rows: int = MAX_ROWS_PER_FILE) -> int:
    """Compact what has come since the last time; returns the number of files taken in."""
    return CompactedTable(spark, source, target, by).compact(max_rows)
