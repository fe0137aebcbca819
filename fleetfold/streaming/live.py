"""The live tables: each micro-batch goes through the batch operators into a ``BatchTable``.

A failing batch raises, so the checkpoint does not advance over lost rows; a replayed batch
overwrites its own directory. Each batch is scanned once for what it writes; splitting off late events takes
one scan more for the greatest event time.
"""

from __future__ import annotations

import contextlib
import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetfold.functions.time import instant, micros
from fleetfold.operators.clean import has_position, live_fleet_project, live_orders_project, order_perf_project
from fleetfold.operators.dims import UNKNOWN_KEY
from fleetfold.operators.kpi import merge_lags
from fleetfold.operators.merge import ORDER_PERFORMANCE, Policies, fold_state, latest_per_key, merge_states, read_state
from fleetfold.operators.star import fact_keys, restated
from fleetfold.operators.telemetry import dedup_window, merge_segments, track_segments
from fleetfold.session import scratch_scope
from fleetfold.sources.tables import BatchTable, VersionedTable, within_retention

FLEET_ORDER = ["updated_at", "event_id"]
LOG = logging.getLogger("fleetfold.live")
PerBatch = Callable[[DataFrame, int], None]


def start(stream: DataFrame, per_batch: PerBatch, checkpoint: str, every: str | None) -> StreamingQuery:
    """``every`` sets a periodic trigger; without it the query drains what is there and stops.

    What a batch pins on its way is dropped with the batch.
    """

    def in_scope(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            per_batch(batch, batch_id)

    writer = stream.writeStream.foreachBatch(in_scope).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def counted(rows: DataFrame, name: str, **more: Column) -> tuple[DataFrame, Observation]:
    """Count the rows, and whatever else, while they are written, without a second pass."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in more.items()]), seen


def metrics_table(spark: SparkSession, root: str) -> BatchTable:
    return BatchTable(spark, root)


def put_counted(table: BatchTable, batch_id: int, read: Observation, rows: DataFrame, what: str, metrics: BatchTable | None) -> None:
    """Write a batch; log, and keep if asked to, how many rows it brought and how many were written."""
    rows, written = counted(rows, f"{what}-written-{batch_id}")
    if table.put(rows, batch_id):
        n_read, n_written = read.get["rows"], written.get["rows"]
        LOG.info("batch %d: %d rows, %d %s", batch_id, n_read, n_written, what)
        if metrics is not None:
            line = table.spark.createDataFrame([(batch_id, n_read, n_written)], "batch long, rows_read long, rows_written long")
            metrics.put(line, batch_id)


# Live fleet: newest ping per courier.


def fleet_table(spark: SparkSession, root: str) -> BatchTable:
    return BatchTable(spark, root, lambda df: latest_per_key(df, ["courier_id"], FLEET_ORDER))


def live_fleet(
    pings: DataFrame, table: BatchTable, checkpoint: str, every: str | None = "1 second", fold_every: int = 20,
    late: LateEvents | None = None, metrics: BatchTable | None = None,
) -> StreamingQuery:
    """With ``late``, events that come too late for the live view are set aside for the batch layer."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch, read = counted(batch, f"pings-{batch_id}")
        newest = latest_per_key(live_fleet_project(batch), ["courier_id"], FLEET_ORDER)
        put_counted(table, batch_id, read, newest, "couriers", metrics)
        if batch_id and batch_id % fold_every == 0:
            table.fold(batch_id)

    return start(pings, per_batch if late is None else late.split(per_batch), checkpoint, every)


# Live orders: a log that has each order once and forgets it after a day.


def first_of_each_order(orders: DataFrame) -> DataFrame:
    known = orders.where("order_id is not null")
    return latest_per_key(known, ["order_id"], ["order_timestamp", "ingestion_timestamp"], first=True)


def orders_table(spark: SparkSession, root: str, period: str = "day") -> BatchTable:
    """Copies of an order in several batches become one when read, so no batch has to look at the log."""
    return BatchTable(spark, root, first_of_each_order, F.col("order_timestamp"), period)


def live_orders(
    orders: DataFrame, table: BatchTable, checkpoint: str, every: str | None = "2 seconds",
    as_of=None, fold_every: int = 20, keep_hours: int | None = 24, metrics: BatchTable | None = None,
) -> StreamingQuery:
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch, read = counted(batch, f"orders-{batch_id}")
        put_counted(table, batch_id, read, first_of_each_order(live_orders_project(batch, as_of)), "orders", metrics)
        if batch_id and batch_id % fold_every == 0:
            table.fold(batch_id)
            forget(table, as_of, keep_hours)

    return start(orders, per_batch, checkpoint, every)


def forget(table: BatchTable, as_of, keep_hours: int | None) -> None:
    """Drop the date folders that lie wholly outside the retention window."""
    if keep_hours is not None:
        table.drop_before(instant(as_of) - F.expr(f"INTERVAL {int(keep_hours)} HOURS"))


def read_orders(table: BatchTable, as_of=None, keep_hours: int | None = 24) -> DataFrame | None:
    """The log without what is older than the window, to the second whatever has been dropped so far."""
    rows = table.read()
    return rows if rows is None or keep_hours is None else rows.where(within_retention("order_timestamp", as_of, keep_hours))


# Order performance: one fact per order, merged column by column.


@dataclass(frozen=True)
class Dimensions:
    courier: DataFrame
    customer: DataFrame
    status: DataFrame
    pizzeria: DataFrame

    @contextlib.contextmanager
    def snapshot(self) -> Iterator[Dimensions]:
        """The same rows for every batch."""
        yield self


class GoldDimensions:
    """The gold dimensions as the last loads left them, for each batch anew.

    A batch holds a lease on the versions it reads, so that loads that end meanwhile do not drop them under it; members
    that came since the last batch are known to the next.
    """

    TABLES = {"courier": "dim_courier", "customer": "dim_customer", "status": "dim_order_status", "pizzeria": "dim_pizzeria"}

    def __init__(self, spark: SparkSession, gold: str):
        self.tables = {name: VersionedTable(spark, f"{gold}/{table}") for name, table in self.TABLES.items()}

    def missing(self) -> list[str]:
        return [table.root for table in self.tables.values() if not table.newest()]

    @contextlib.contextmanager
    def snapshot(self) -> Iterator[Dimensions]:
        with contextlib.ExitStack() as leases:
            held = {name: leases.enter_context(table.lease()) for name, table in self.tables.items()}
            if any(rows is None for rows in held.values()):
                raise LookupError(f"dimensions that were never loaded: {self.missing()}")
            yield Dimensions(**held)


# Facts that keep the courier's code beside the key of the version of their time, so that they can be restated.
AS_OF_PERFORMANCE = replace(ORDER_PERFORMANCE, latest=(*ORDER_PERFORMANCE.latest, "courier_id"))


def performance_table(spark: SparkSession, root: str, policies: Policies = ORDER_PERFORMANCE) -> BatchTable:
    return BatchTable(spark, root, lambda df: merge_states(df, policies), F.col("first.order_timestamp"))


def order_performance(
    pings: DataFrame, table: BatchTable, dims: Dimensions | GoldDimensions, checkpoint: str, every: str | None = "1 second",
    policies: Policies = ORDER_PERFORMANCE, as_of=None, fold_every: int = 50, keep_hours: int | None = 24,
    courier_at: str | None = None, metrics: BatchTable | None = None,
) -> StreamingQuery:
    """With ``courier_at`` (and ``AS_OF_PERFORMANCE``) a fact has the courier's version of that time, else the current one."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch, read = counted(batch, f"pings-{batch_id}")
        with dims.snapshot() as now:
            facts = fact_keys(order_perf_project(batch), now.courier, now.customer, now.status, now.pizzeria, courier_at)
            put_counted(table, batch_id, read, fold_state(facts, policies), "facts", metrics)
        if batch_id and batch_id % fold_every == 0:
            table.fold(batch_id)
            forget(table, as_of, keep_hours)

    return start(pings, per_batch, checkpoint, every)


def restated_couriers(facts: DataFrame, couriers: DataFrame, at: str = "order_timestamp", changed: DataFrame | None = None) -> DataFrame:
    """Facts read with ``AS_OF_PERFORMANCE`` whose courier version is another one by now, with its key."""
    return restated(facts, couriers, "courier_id", at, ["courier_key"], {"courier_key": UNKNOWN_KEY}, changed)


def read_performance(
    table: BatchTable, policies: Policies = ORDER_PERFORMANCE, as_of=None, keep_hours: int | None = None
) -> DataFrame | None:
    """Facts as plain columns; with ``keep_hours`` only those of orders within the window."""
    state = table.read()
    if state is None:
        return None
    rows = read_state(state, policies)
    return rows if keep_hours is None else rows.where(within_retention("order_timestamp", as_of, keep_hours))


# Odometer: track segments per trip.


def odometer_table(spark: SparkSession, root: str) -> BatchTable:
    return BatchTable(spark, root, merge_segments, F.col("segment"))


def odometer(
    pings: DataFrame, table: BatchTable, checkpoint: str, every: str | None = "1 second", ts: str = "timestamp", tie: str = "event_id",
    fold_every: int = 20, metrics: BatchTable | None = None,
) -> StreamingQuery:
    """Kilometres per trip, whatever the order in which pings arrive; read with ``segment_totals(table.read())``."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch, read = counted(batch, f"pings-{batch_id}")
        put_counted(table, batch_id, read, track_segments(batch.where(has_position()), ts, tie), "segments", metrics)
        if batch_id and batch_id % fold_every == 0:
            table.fold(batch_id)

    return start(pings, per_batch, checkpoint, every)


# Lag from event to arrival: folds of counts and quantile sketches.


def lag_table(spark: SparkSession, root: str) -> BatchTable:
    return BatchTable(spark, root, merge_lags)


# Events that come too late for the live view are set aside for the batch layer.


class LateEvents:
    """Splits each batch as a watermark would: what it lets through goes on, the rest is kept in ``late``.

    ``seen`` keeps the greatest event time of each batch. The rule is that of ``late_data_split``, so a batch that
    is taken again is split alike.
    """

    def __init__(self, spark: SparkSession, root: str, ts: Column, minutes: int = 10):
        self.seen = BatchTable(spark, f"{root}/seen", lambda df: df.agg(F.max("seen_us").alias("seen_us")))
        self.late = BatchTable(spark, f"{root}/late")
        self.ts, self.minutes = ts, minutes

    def split(self, on_time: PerBatch, fold_every: int = 20) -> PerBatch:
        """Wrap a batch function so that it gets the events in time."""

        def per_batch(batch: DataFrame, batch_id: int) -> None:
            self.seen.put(batch.agg(F.max(micros(self.ts)).alias("seen_us")), batch_id)
            earlier = self.seen.read(batch_id - 2)
            greatest = None if earlier is None else earlier.agg(F.max("seen_us")).first()[0]
            if greatest is None:
                self.late.put(batch.where(F.lit(False)), batch_id)
                return on_time(batch, batch_id)
            watermark = (greatest // 1000 - self.minutes * 60_000) * 1000
            is_late = F.coalesce(micros(self.ts) <= F.lit(watermark), F.lit(False))
            self.late.put(batch.where(is_late), batch_id)
            on_time(batch.where(~is_late), batch_id)
            if batch_id % fold_every == 0:
                self.seen.fold(batch_id - 3)  # a batch that is taken again looks at those before the last but one

        return per_batch


# Copies within ten minutes of event time.


def drop_copies(events: DataFrame, key: str, ts: str, minutes: int = 10) -> DataFrame:
    """First event per key within the watermark; state is Spark's own and leaves with the watermark."""
    return events.withWatermark(ts, f"{minutes} minutes").dropDuplicatesWithinWatermark([key])


class LastSeen:
    """The last event per key, in buckets of the key's hash.

    A batch writes and reads the buckets that its own keys fall into, and of those only files of the days within reach of
    its events: what it opens depends on the batch, not on how many keys or days are stored.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, ts: str, tie: str, minutes: int = 10, buckets: int = 256):
        self.key, self.ts, self.tie, self.minutes = key, ts, tie, minutes
        self.buckets = buckets
        self.table = BatchTable(spark, root, self._newest, F.col(ts), buckets=(self._bucket(F.col(key)), "_bucket"))

    def _newest(self, df: DataFrame) -> DataFrame:
        return latest_per_key(df.select(self.key, self.ts, self.tie), [self.key], [self.ts, self.tie])

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def before(self, batch: DataFrame, batch_id: int) -> DataFrame | None:
        """The last earlier events, within the window, of the keys of a batch."""
        span = batch.agg(F.min(self.ts), F.max(self.ts), F.collect_set(self._bucket(F.col(self.key)))).first()
        if span[0] is None:
            return None
        reach = F.lit(span[0]) - F.expr(f"INTERVAL {int(self.minutes)} MINUTES")
        days = self.table.spark.range(1).select(F.to_date(reach), F.to_date(F.lit(span[1]))).first()
        stored = self.table.read(batch_id - 1, F.col("_from").between(*map(F.lit, days)) & F.col("_bucket").isin(span[2]))
        if stored is None:
            return None
        keys = batch.select(F.col(self.key).alias("_key")).distinct()
        return stored.join(keys, F.col(self.key).eqNullSafe(F.col("_key")), "left_semi")


def spaced_events(
    events: DataFrame, last_seen: LastSeen, out: BatchTable, checkpoint: str, every: str | None = None, fold_every: int = 20
) -> StreamingQuery:
    """Keep an event unless the previous one of its key is less than the window before it, kept or not.

    The state is the last event per key, a fold. For a feed in order of event time the result is that of ``dedup_window``,
    however the feed is cut into batches. State older than the newest event by a day and the window is dropped.
    """
    key, ts, tie, minutes = last_seen.key, last_seen.ts, last_seen.tie, last_seen.minutes

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if last_seen.table.contains(batch_id):
            return
        before = last_seen.before(batch, batch_id)
        both = batch.withColumn("_old", F.lit(False))
        if before is not None:
            both = both.unionByName(before.withColumn("_old", F.lit(True)), allowMissingColumns=True)
        kept = dedup_window(both, key, ts, tie, minutes).where(~F.col("_old")).drop("_old")
        out.put(kept, batch_id)
        last_seen.table.put(latest_per_key(batch.select(key, ts, tie), [key], [ts, tie]), batch_id)
        if batch_id and batch_id % fold_every == 0:
            newest = batch.agg(F.max(ts)).first()[0]
            last_seen.table.fold(batch_id)
            if newest is not None:
                last_seen.table.drop_before(F.lit(newest) - F.expr(f"INTERVAL {int(minutes)} MINUTES"))

    return start(events, per_batch, checkpoint, every)
