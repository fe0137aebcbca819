"""Questions to the ping stream as a table: latest state, trips, life cycles, lateness, copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetfold.functions.geo import haversine_km, step_towards
from fleetfold.functions.time import micros
from fleetfold.operators.merge import latest_per_key
from fleetfold.plans.joins import lookup
from fleetfold.plans.ordered import MAX_GROUP_ROWS, Ordered, with_previous, with_running

# Status changes of a regular trip, and statuses that may be reported repeatedly.
REGULAR_CHANGES = [
    ("IDLE", "PREPARING"),
    ("PREPARING", "IN_REALIZATION"),
    ("IN_REALIZATION", "AT_CUSTOMER"),
    ("AT_CUSTOMER", "DELIVERED"),
    ("DELIVERED", "RETURNING"),
    ("RETURNING", "IDLE"),
]
MAY_FAIL = ["PREPARING", "IN_REALIZATION", "AT_CUSTOMER", "DELIVERED"]
FAILURE = "CRITICAL_FAILURE"
MAY_REPEAT = ["IDLE", "PREPARING", "IN_REALIZATION", "AT_CUSTOMER", "RETURNING"]
MOVING = ("IN_REALIZATION", "RETURNING")


def latest_per_courier(pings: DataFrame, ts: str = "timestamp", tie: str = "event_id") -> DataFrame:
    return latest_per_key(pings, ["courier_id"], [ts, tie])


def latest_per_order(pings: DataFrame, ts: str = "timestamp", tie: str = "event_id") -> DataFrame:
    return latest_per_key(pings.where("order_id is not null"), ["order_id"], [ts, tie])


def allowed_transitions(spark: SparkSession) -> DataFrame:
    pairs = REGULAR_CHANGES + [(s, FAILURE) for s in MAY_FAIL] + [(s, s) for s in MAY_REPEAT]
    rows = ", ".join(f"('{a}', '{b}')" for a, b in pairs)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS allowed(from_status, to_status)")


def status_transitions(
    pings: DataFrame, status: str, ts: str, tie: str = "event_id", max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """How often each pair of consecutive statuses of a courier occurs, and whether it is allowed."""
    narrow = pings.select("courier_id", status, ts, tie)
    steps = with_previous(narrow, ["courier_id"], [ts, tie], [status], "from_", max_group_rows)
    counted = (
        steps.where(F.col(f"from_{status}").isNotNull())
        .groupBy(F.col(f"from_{status}").alias("from_status"), F.col(status).alias("to_status"))
        .agg(F.count(F.lit(1)).alias("transitions"))
    )
    rules = F.broadcast(allowed_transitions(pings.sparkSession).withColumn("_rule", F.lit(True)))
    judged = lookup(counted, rules, ["from_status", "to_status"])
    return judged.select("from_status", "to_status", "transitions", F.coalesce("_rule", F.lit(False)).alias("allowed"))


def trip_odometer(
    pings: DataFrame,
    ts: str,
    tie: str = "event_id",
    status: str | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Per ping the kilometres since the previous ping of the trip and since its first one.

    Hops are rounded to a millimetre and summed as decimals, so the total depends on no order of
    addition. With ``status`` only hops that end in a moving status count.
    """
    trip = ["courier_id", "order_id"]
    steps = Ordered(pings, trip, [ts, tie], max_group_rows).previous(["lat", "lon"])
    hop = F.coalesce(F.round(haversine_km("prev_lat", "prev_lon", "lat", "lon"), 6), F.lit(0.0)).cast("decimal(18,6)")
    if status is not None:
        hop = F.when(F.col(status).isin(*MOVING), hop).otherwise(F.lit(0).cast("decimal(18,6)"))
    hops = steps.map(lambda df: df.withColumn("hop_km", hop).drop("prev_lat", "prev_lon"))
    return hops.running({"odometer_km": ("sum", "hop_km")}).result()


def trip_totals(pings: DataFrame, ts: str, tie: str = "event_id", max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Pings and kilometres per trip."""
    trip = ["courier_id", "order_id"]
    narrow = pings.select(*trip, ts, tie, "lat", "lon")
    steps = with_previous(narrow, trip, [ts, tie], ["lat", "lon"], "prev_", max_group_rows)
    hop = F.round(haversine_km("prev_lat", "prev_lon", "lat", "lon"), 6).cast("decimal(18,6)")
    return steps.groupBy(*trip).agg(
        F.count(F.lit(1)).alias("pings"),
        F.coalesce(F.sum(hop), F.lit(0).cast("decimal(28,6)")).alias("trip_km"),
    )


# Track segments: the pings of a trip within a span of time, in order. Segments of a trip merge in any order and any
# number of times to what all pings at once would give, so they are the state of an odometer over a stream.

SEGMENT_SECONDS = 3600
SEGMENT = ["courier_id", "order_id", "segment"]
KM = "decimal(28,6)"


def track_segments(pings: DataFrame, ts: str, tie: str = "event_id", seconds: int = SEGMENT_SECONDS) -> DataFrame:
    """``courier_id``, ``order_id``, ``segment`` (its begin) and ``points`` in order. A segment holds what one courier
    sends in its span; pings without a courier or time belong to no track."""
    known = pings.where(F.col("courier_id").isNotNull() & F.col(ts).isNotNull())
    begin = F.timestamp_seconds(F.floor(micros(ts) / (seconds * 1_000_000)) * seconds).alias("segment")
    point = F.struct(micros(ts).alias("at"), F.col(tie).alias("tie"), "lat", "lon")
    return merge_segments(known.select("courier_id", "order_id", begin, F.array(point).alias("points")))


def merge_segments(segments: DataFrame) -> DataFrame:
    """Segments of the same span as one; a ping that came late takes its place, one that came twice counts once."""
    points = F.array_sort(F.array_distinct(F.flatten(F.collect_list("points"))))
    return segments.groupBy(*SEGMENT).agg(points.alias("points"))


def segment_totals(segments: DataFrame) -> DataFrame:
    """Pings and kilometres per trip: those within its segments, and the hops from one segment to the next."""

    def hop(a: Column, b: Column) -> Column:
        return F.round(haversine_km(a["lat"], a["lon"], b["lat"], b["lon"]), 6).cast("decimal(18,6)")

    points, n = F.col("points"), F.size("points")
    inside = F.transform(F.sequence(F.lit(1), n - 1), lambda i: hop(points[i - 1], points[i]))
    inside = F.when(n > 1, F.aggregate(inside, F.lit(0).cast(KM), lambda a, h: (a + h).cast(KM))).otherwise(F.lit(0).cast(KM))
    slim = segments.select(*SEGMENT, n.alias("n"), inside.alias("km"), points[0].alias("first"), points[n - 1].alias("last"))
    # A trip has few segments, whatever the number of its pings.
    before = F.lag("last").over(Window.partitionBy("courier_id", "order_id").orderBy("segment"))
    linked = slim.withColumn("_before", before).withColumn("km", F.col("km") + F.coalesce(hop(F.col("_before"), F.col("first")), F.lit(0).cast(KM)))
    return linked.groupBy("courier_id", "order_id").agg(F.sum("n").alias("pings"), F.sum("km").cast(KM).alias("trip_km"))


def interpolate_position(pings: DataFrame, to_lat, to_lon, step_km: Column) -> DataFrame:
    """Add the position after the next step towards a target, and whether it is reached."""
    lat, lon = step_towards("lat", "lon", to_lat, to_lon, step_km)
    arrived = haversine_km("lat", "lon", to_lat, to_lon) <= step_km
    return pings.withColumns({"next_lat": lat, "next_lon": lon, "arrived": arrived})


def resample(pings: DataFrame, ts: str, tie: str, every_seconds: int, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Positions of each trip on a regular time grid, straight between two pings."""
    trip = ["courier_id", "order_id"]
    narrow = pings.select(*trip, ts, tie, "lat", "lon")
    legs = with_previous(narrow, trip, [ts, tie], [ts, "lat", "lon"], "from_", max_group_rows)
    start, end = micros(f"from_{ts}"), micros(ts)
    step = every_seconds * 1_000_000
    first, last = F.ceil(start / step).cast("long"), F.ceil(end / step).cast("long") - 1
    gridded = legs.where(F.col(f"from_{ts}").isNotNull() & (first <= last)).withColumn(
        "_tick", F.explode(F.sequence(first, last))
    )
    share = (F.col("_tick") * step - start) / (end - start)
    return gridded.select(
        *trip,
        F.timestamp_micros(F.col("_tick") * step).alias("at"),
        (F.col("from_lat") + (F.col("lat") - F.col("from_lat")) * share).alias("lat"),
        (F.col("from_lon") + (F.col("lon") - F.col("from_lon")) * share).alias("lon"),
    )


def order_lifecycle(pings: DataFrame, status: str, ts: str, planned: list[str] | None = None) -> DataFrame:
    """First time each stage of an order was seen. ``planned`` times are passed through."""
    stages = {
        "pickup_timestamp": "IN_REALIZATION",
        "delivery_timestamp": "DELIVERED",
        "return_timestamp": "RETURNING",
        "failure_timestamp": FAILURE,
    }
    seen = [F.min(F.when(F.col(status) == s, F.col(ts))).alias(name) for name, s in stages.items()]
    kept = [F.min(c).alias(c) for c in planned or []]
    return pings.where("order_id is not null").groupBy("order_id").agg(F.min(ts).alias("first_seen"), *kept, *seen)


def late_data_split(
    events: DataFrame, batch: str, ts: str, delay_minutes: int = 10, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Mark the events a watermark of ``delay_minutes`` would drop, given their micro-batch number.

    An event of batch b is late when it lies at or before M - delay, where M is the greatest event
    time of the batches up to b - 2, cut to the millisecond: the watermark a running query applies
    to batch b was fixed when batch b - 1 was planned. Holds for batches without empty runs between.
    """
    per_batch = events.groupBy(batch).agg(F.max(micros(ts)).alias("_seen"))
    running = with_running(per_batch, [], [batch], {"_upto": ("max", "_seen")}, max_group_rows)
    delay = delay_minutes * 60_000
    watermark = running.select(
        (F.col(batch) + 2).alias(batch),
        (F.floor(F.col("_upto") / 1000).cast("long") - F.lit(delay)).alias("_watermark_ms"),
    )
    marked = lookup(events, watermark, batch, spread_by=[ts])
    late = F.coalesce(micros(ts) <= F.col("_watermark_ms") * 1000, F.lit(False))
    return marked.withColumn("is_late", late).drop("_watermark_ms")


def dedup_window(
    events: DataFrame, key: str, ts: str, tie: str, minutes: int = 10, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Keep an event unless the previous one of its key is less than ``minutes`` before it."""
    gaps = with_previous(events, [key], [ts, tie], [ts], "prev_", max_group_rows)
    gap = micros(ts) - micros(f"prev_{ts}")
    return gaps.where(F.col(f"prev_{ts}").isNull() | (gap >= minutes * 60_000_000)).drop(f"prev_{ts}")
