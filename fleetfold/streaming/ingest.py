"""Bronze to silver: drain the JSON feeds into partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetfold.operators.clean import clean_orders, clean_telemetry, has_revenue
from fleetfold.schemas import ORDER_EVENT, TELEMETRY_EVENT
from fleetfold.sources.files import stream_json
from fleetfold.sources.tables import MAX_ROWS_PER_FILE

FILES_PER_DRAIN = 10_000


def drain_to_parquet(
    rows: DataFrame, path: str, checkpoint: str, by: str | None = None, max_rows: int = MAX_ROWS_PER_FILE
) -> StreamingQuery:
    """Append what is there now, then stop. Rows of one partition are gathered before the write, so
    that a task does not open a file in every partition; a partition that holds most of a
    micro-batch is split again by adaptive execution."""
    if by is not None:
        rows = rows.hint("rebalance", F.col(by))
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint).option("maxRecordsPerFile", max_rows)
    if by is not None:
        writer = writer.partitionBy(by)
    return writer.trigger(availableNow=True).start()


def silver_orders(
    spark: SparkSession, bronze: str, silver: str, checkpoint: str,
    max_files: int = FILES_PER_DRAIN, archive_to: str | None = None, as_of=None, by: str = "order_date", derive=None,
    max_rows: int = MAX_ROWS_PER_FILE,
) -> StreamingQuery:
    """``derive`` may add a coarser partition column for a feed that spans many dates. Orders that are left out are
    counted in the query's progress, under ``orders``."""
    events = stream_json(spark, bronze, ORDER_EVENT, max_files, archive_to)
    counted = events.observe("orders", F.count(F.lit(1)).alias("read"), F.count_if(~has_revenue()).alias("rejected"))
    rows = clean_orders(counted, as_of)
    return drain_to_parquet(derive(rows) if derive else rows, silver, checkpoint, by, max_rows)


def silver_telemetry(
    spark: SparkSession, bronze: str, silver: str, checkpoint: str,
    max_files: int = FILES_PER_DRAIN, archive_to: str | None = None, as_of=None, max_rows: int = MAX_ROWS_PER_FILE,
) -> StreamingQuery:
    rows = clean_telemetry(stream_json(spark, bronze, TELEMETRY_EVENT, max_files, archive_to), as_of)
    return drain_to_parquet(rows, silver, checkpoint, "event_date", max_rows)
