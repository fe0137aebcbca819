"""Every operator as a named query over the test tables.

A query returns plain types (no decimals, no zoned times), so that its result compares with SQL.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, IntegerType, ShortType, TimestampType

from fleetfold import schemas
from fleetfold.catalog import views
from fleetfold.catalog.views import ISO, ntz, table
from fleetfold.functions import delivery as rules
from fleetfold.functions.geo import haversine_km
from fleetfold.functions.time import parse
from fleetfold.operators import clean, dims, kpi, merge, spatial, star, telemetry
from fleetfold.plans.daily import GOLD_DIMENSIONS, load_gold_dimensions
from fleetfold.plans.joins import lookup
from fleetfold.session import pin, scratch, tune
from fleetfold.sources import compaction, files, tables
from fleetfold.streaming import ingest, live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NOW = "2024-02-01 00:00:00"


def now() -> Column:
    """The fixed clock of the queries."""
    return ntz(NOW)


def comparable(df: DataFrame) -> DataFrame:
    def plain(field) -> Column:
        c, kind = F.col(field.name), field.dataType
        if isinstance(kind, DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(kind, (ByteType, ShortType, IntegerType)):
            return c.cast("long").alias(field.name)
        if isinstance(kind, TimestampType):
            return c.cast("timestamp_ntz").alias(field.name)
        return c

    return df.select(*[plain(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(tune(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return fn


# Cleaning, typing and projections.


@query
def clean_orders(spark, sf):
    return clean.clean_orders(views.orders(spark, sf), now()).drop("pizzeria_lat", "pizzeria_lon")


@query
def clean_telemetry(spark, sf):
    return clean.clean_telemetry(views.pings(spark, sf), now()).drop("return_timestamp")


@query
def live_fleet_project(spark, sf):
    return clean.live_fleet_project(views.pings(spark, sf))


@query
def live_orders_project(spark, sf):
    return clean.live_orders_project(views.orders(spark, sf), now())


@query
def order_perf_project(spark, sf):
    return clean.order_perf_project(views.pings(spark, sf)).drop("return_timestamp")


@query
def enforce_types(spark, sf):
    types = {"c_custkey": "string", "c_nationkey": "string", "c_acctbal": "decimal(10,1)", "absent": "int"}
    typed = clean.enforce_types(table(spark, sf, "customer"), types)
    # Text that is no number becomes null where a load must not fail.
    return clean.enforce_types(typed.withColumn("segment_no", F.col("c_mktsegment")), {"segment_no": "int"}, safe=True)


# Dimensions.


@query
def dim_date(spark, sf):
    """The calendar of the orders' period, with the orders of each date."""
    o = views.orders(spark, sf)
    bounds = o.agg(F.min("order_timestamp").alias("first"), F.max("order_timestamp").alias("last"))
    days = dims.date_attributes(dims.date_spine(bounds, "first", "last"))
    per_day = o.groupBy(F.to_date("order_timestamp").alias("full_date")).agg(F.count(F.lit(1)).alias("_n"))
    return lookup(days, per_day, "full_date").withColumn("orders", F.coalesce("_n", F.lit(0))).drop("_n")


@query
def dim_static(spark, sf):
    """Deliveries per status and zone, with the attributes of both."""
    counts = (
        views.deliveries(spark, sf)
        .groupBy(F.col("status").alias("status_name"), "zone_key")
        .agg(F.count(F.lit(1)).alias("deliveries"))
    )
    with_status = lookup(counts, F.broadcast(dims.order_statuses(spark)), "status_name")
    return lookup(with_status, F.broadcast(dims.delivery_zones(spark)), "zone_key")


@query
def dim_courier_shape(spark, sf):
    return dims.shape_couriers(views.couriers(spark, sf), now())


@query
def dim_pizzeria_shape(spark, sf):
    shaped = dims.shape_pizzerias(views.bases(spark, sf))
    ok = F.col("kitchen_performance_factor").between(0.8, 1.2).alias("factor_in_range")
    return shaped.select("*", ok).drop("kitchen_performance_factor")


@query
def dim_customer_shape(spark, sf):
    shaped = dims.shape_customers(views.customers(spark, sf))
    ok = F.col("dropoff_difficulty_score").between(0, 1).alias("score_in_range")
    return shaped.select("*", ok).drop("dropoff_difficulty_score")


@query
def gold_dims_load(spark, sf):
    """Rows per gold dimension, unknown member included, after the first load and after the same again."""
    o = views.orders(spark, sf)
    bounds = o.agg(F.min("order_timestamp").alias("first"), F.max("order_timestamp").alias("last"))
    staged = {
        "dim_courier": dims.shape_couriers(views.couriers(spark, sf), now()),
        "dim_pizzeria": dims.shape_pizzerias(views.bases(spark, sf)),
        "dim_customer": dims.shape_customers(views.customers(spark, sf)),
        "dim_delivery_zone": dims.delivery_zones(spark),
        "dim_order_status": dims.order_statuses(spark),
        "dim_date": dims.date_attributes(dims.date_spine(bounds, "first", "last")),
    }
    gold = scratch(spark, "gold")
    load_gold_dimensions(spark, gold, staged, now())
    load_gold_dimensions(spark, gold, staged, ntz("2024-02-02 00:00:00"))
    out = None
    for spec in GOLD_DIMENSIONS:
        versions = tables.VersionedTable(spark, f"{gold}/{spec.name}").versions()
        first, second = (spark.read.parquet(versions[v]).drop(merge.SEEN_AT) for v in (1, 2))
        unchanged = first.intersectAll(second).agg(F.count(F.lit(1)).alias("rows_unchanged"))
        loaded = second.agg(F.count(F.lit(1)).alias("rows_loaded"))
        line = loaded.select(
            F.lit(spec.name).alias("dimension"), "rows_loaded", unchanged.scalar().alias("rows_unchanged")
        )
        out = line if out is None else out.unionByName(line)
    return out


# Column rules.


@query
def status_relabel(spark, sf):
    d = views.deliveries(spark, sf)
    return d.select("order_id", "status", rules.display_status("status").alias("simple_order_status"))


@query
def progress_percent(spark, sf):
    at = views.plus_seconds(F.col("order_ts"), F.lit(100))
    d = views.deliveries(spark, sf)
    return d.select("order_id", rules.progress_percent("status", "pickup_ts", at).alias("realization_percent"))


@query
def avg_speed(spark, sf):
    d = views.deliveries(spark, sf)
    return d.select("order_id", rules.average_speed_kmh("total_distance", "total_time").alias("average_speed_kmh"))


@query
def sla_clock(spark, sf):
    left, late = rules.sla_clock("status", "ping_ts", "order_ts", "delivery_ts")
    return views.deliveries(spark, sf).select("order_id", left.alias("time_left_sec"), late.alias("is_delayed"))


@query
def distance_left(spark, sf):
    left = rules.distance_left_km("status", "km_to_target", "total_distance")
    return views.deliveries(spark, sf).select("order_id", left.alias("distance_left_km"))


@query
def realization_percent(spark, sf):
    share = rules.realization_percent("status", "km_to_target", "total_distance")
    return views.deliveries(spark, sf).select("order_id", share.alias("realization_percent"))


@query
def speed_normalise(spark, sf):
    p = views.pings(spark, sf)
    return p.select("event_id", rules.speed_kmh("speed", "status_key").alias("speed_kmh"))


# Lookups and the star schema.


def _keyed_dims(spark, sf) -> dict[str, DataFrame]:
    """Dimensions with surrogate keys that are known in advance, read off the natural keys."""

    def keyed(dim: DataFrame, name: str, number: str) -> DataFrame:
        return dim.withColumn(name, F.expr(number))

    return {
        "courier": keyed(
            dims.shape_couriers(views.couriers(spark, sf), now()),
            "courier_key",
            "CAST(split_part(courier_id, '-', 3) AS BIGINT) + 1000",
        ),
        "pizzeria": keyed(
            dims.shape_pizzerias(views.bases(spark, sf)),
            "pizzeria_key",
            "CAST(regexp_extract(pizzeria_id, 'N([0-9]+)', 1) AS BIGINT) + 500",
        ),
        "customer": keyed(dims.shape_customers(views.customers(spark, sf)), "customer_key", "customer_id + 1"),
        "status": dims.order_statuses(spark),
        "zone": dims.delivery_zones(spark),
    }


def _progress_of_deliveries(spark, sf) -> DataFrame:
    """Deliveries in the columns of order progress, with courier codes as natural keys."""
    codes = views.couriers(spark, sf).select(F.col("courier_no").alias("courier_id"), F.col("courier_id").alias("code"))
    d = lookup(views.deliveries(spark, sf), codes, "courier_id")
    return d.select(
        "order_id",
        F.col("code").alias("courier_id"),
        "customer_id",
        F.col("status").alias("status_key"),
        "zone_key",
        F.col("order_ts").alias("order_timestamp"),
        F.col("prep_ts").alias("preparation_timestamp"),
        F.col("pickup_ts").alias("pickup_timestamp"),
        F.col("delivery_ts").alias("delivery_timestamp"),
        "total_distance",
        "total_time",
        "outside_geofence",
    )


def _facts(spark, sf, d: dict[str, DataFrame]) -> DataFrame:
    return star.fact_keys(_progress_of_deliveries(spark, sf), d["courier"], d["customer"], d["status"], d["pizzeria"])


@query
def fact_key_lookup(spark, sf):
    keys = ["order_id", "courier_key", "pizzeria_key", "customer_key", "status_key", "zone_key", "date_key"]
    return _facts(spark, sf, _keyed_dims(spark, sf)).select(*keys)


@query
def computed_key_join(spark, sf):
    keyed = star.base_by_courier_code(_progress_of_deliveries(spark, sf), _keyed_dims(spark, sf)["pizzeria"])
    return keyed.select("order_id", F.col("courier_id").alias("courier_code"), "pizzeria_key")


@query
def courier_base_join(spark, sf):
    joined = star.courier_with_base(views.couriers(spark, sf), views.bases(spark, sf))
    return joined.select("courier_id", "pizzeria_id", "pizzeria_name", "raw_id", "base_raw_id", "lat", "lon")


@query
def order_360(spark, sf):
    d = _keyed_dims(spark, sf)
    log = clean.live_orders_project(views.orders(spark, sf), now())
    log = clean.enforce_types(log, {"gross_revenue": kpi.MONEY, "delivery_charge": "decimal(10,2)"})
    at = views.plus_seconds(F.col("order_timestamp"), F.lit(100))
    return star.order_360(
        _facts(spark, sf, d), log, d["courier"], d["pizzeria"], d["customer"], d["status"], d["zone"], at
    )


# Merges.


@query
def insert_absent(spark, sf):
    (_, first), (_, second), _ = views.courier_snapshots(spark, sf)
    return merge.insert_absent(first, second, "courier_id").select("courier_id", "courier_no", "vehicle_type")


@query
def surrogate_keys(spark, sf):
    c = views.couriers(spark, sf).select("courier_id", "courier_no")
    return merge.surrogate_keys(c, "courier_id", "courier_key", after=100)


@query
def changed_rows(spark, sf):
    first, second = (dims.shape_couriers(rows, now()) for _, rows in views.courier_snapshots(spark, sf)[:2])
    return merge.changed_rows(first, second, "courier_id", merge.COURIER_TRACKED).select("courier_id", "vehicle_type")


@query
def scd1_merge(spark, sf):
    """Customer dimension after a load that renames some and brings new ones; one column is its own."""
    c, key = views.customers(spark, sf).select("customer_id", "full_name", "segment_tag"), F.col("customer_id")
    target = c.where(key % 10 != 9).withColumn("note", F.concat(F.lit("n"), key.cast("string")))
    staged = c.withColumn("full_name", F.concat("full_name", F.when(key % 4 == 0, " II").otherwise(""))).where(key % 5 != 1)
    return merge.scd1_merge(target, staged, "customer_id")


def _courier_history(spark, sf, repeat_last: bool = False, order: tuple[int, ...] = (0, 1, 2)) -> DataFrame:
    snapshots = views.courier_snapshots(spark, sf)
    loads = [snapshots[k] for k in order]
    if repeat_last:
        loads = [*loads, ("2024-01-25 00:00:00", loads[-1][1])]
    versions = tables.VersionedTable(spark, scratch(spark, "courier_history"))
    _load_couriers(versions, loads)
    return versions.read().drop(merge.SEEN_AT)


def _load_couriers(versions: tables.VersionedTable, loads: list[tuple[str, DataFrame]]) -> None:
    for at, snapshot in loads:
        staged = dims.shape_couriers(snapshot, ntz(at)).select(
            "courier_id", "vehicle_type", *merge.COURIER_TRACKED,
            *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("valid_from", "valid_to")], "is_current",
        )
        target = versions.read()
        if target is None:
            target = staged.where(F.lit(False)).withColumn("courier_key", F.lit(None).cast("long"))
            target = target.withColumn(merge.SEEN_AT, F.array().cast("array<timestamp_ntz>"))
        versions.write(merge.scd2_merge(target, staged, "courier_id", merge.COURIER_TRACKED, ntz(at), "courier_key"))


@query
def scd2_merge(spark, sf):
    return _courier_history(spark, sf)


@query
def scd2_idempotent(spark, sf):
    return _courier_history(spark, sf, repeat_last=True)


@query
def scd2_out_of_order(spark, sf):
    """The history of the couriers from the same loads, the last first, each version named by when it began."""
    return _courier_history(spark, sf, order=(2, 0, 1)).drop("courier_key")


@query
def scd2_asof_join(spark, sf):
    """Pings with the vehicle their courier drove then."""
    codes = views.couriers(spark, sf).select(F.col("courier_no").alias("courier_no"), F.col("courier_id").alias("code"))
    p = views.pings(spark, sf).select("event_id", F.col("courier_id").alias("courier_no"), "timestamp")
    coded = lookup(p, codes, "courier_no")
    history = _courier_history(spark, sf)
    joined = star.as_of_join(coded, history.withColumnRenamed("courier_id", "code"), "code", "timestamp", ["vehicle", "valid_from"])
    return joined.select("event_id", "code", "vehicle", "valid_from")


@query
def latest_per_courier(spark, sf):
    p = views.pings(spark, sf).select("courier_id", "event_id", "timestamp", "status_key", "lat", "lon", "speed")
    return telemetry.latest_per_courier(p)


@query
def latest_per_order(spark, sf):
    p = views.pings(spark, sf).select("order_id", "event_id", "timestamp", "status_key", "total_distance")
    return telemetry.latest_per_order(p)


PING_POLICIES = merge.Policies(
    key="order_id",
    order=("gps_timestamp", "event_id"),
    first=("customer_id", "zone_key", "order_timestamp"),
    latest=("courier_id", "status_key", "outside_geofence", "is_completed"),
    last_known=("preparation_timestamp", "pickup_timestamp", "delivery_timestamp"),
    greatest=("total_distance", "total_time"),
)


def _in_parts(df: DataFrame, by: str, parts: int = 4) -> list[DataFrame]:
    """All rows, dealt to a few rounds by batch number, so that rounds arrive out of order."""
    return [df.where(F.col(by) % parts == i) for i in reversed(range(parts))]


@query
def live_fleet_upsert(spark, sf):
    batched = pin(views.pings_batched(spark, sf), "batched")
    state = None
    for part in _in_parts(batched, "batch"):
        state = merge.upsert_latest(state, clean.live_fleet_project(part), "courier_id", live.FLEET_ORDER)
    return state


@query
def order_perf_fold(spark, sf):
    folded = merge.fold_state(clean.order_perf_project(views.pings(spark, sf)), PING_POLICIES)
    return merge.read_state(folded, PING_POLICIES)


@query
def order_perf_upsert(spark, sf):
    batched = pin(views.pings_batched(spark, sf), "batched")
    state = None
    parts = _in_parts(batched, "batch")
    for part in [*parts, parts[0]]:  # the first round arrives twice
        state = merge.merge_with_policy(state, clean.order_perf_project(part), PING_POLICIES)
    return merge.read_state(state, PING_POLICIES)


@query
def order_perf_reference_batching(spark, sf):
    """The same fold when each batch first keeps the newest row per order only.

    The state is stored between rounds, so a task sorts one round and the state so far, not all rounds at once.
    """
    batched = pin(views.pings_batched(spark, sf), "batched")
    state = None
    for part in _in_parts(batched, "batch"):
        stored = None if state is None else pin(state, "state")
        state = merge.merge_with_policy(stored, clean.order_perf_project(part), PING_POLICIES, reference_batching=True)
    return merge.read_state(state, PING_POLICIES)


@query
def dq_pk_duplicates(spark, sf):
    return star.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_fk_orphans(spark, sf):
    couriers = views.couriers(spark, sf).select("courier_no")
    return star.orphans(views.deliveries(spark, sf).select("order_id", "courier_id"), couriers, "courier_id", "courier_no")


# Key figures.


@query
def daily_kpi(spark, sf):
    return kpi.daily_kpi(clean.clean_orders(views.orders(spark, sf), now()), now())


@query
def on_time_rate(spark, sf):
    d = views.deliveries(spark, sf).withColumn("order_date", F.to_date("order_ts"))
    return kpi.on_time_rate(d, ["order_date"], "order_ts", "delivery_ts")


@query
def courier_efficiency(spark, sf):
    c = views.couriers(spark, sf).drop("courier_id").withColumnRenamed("courier_no", "courier_id")
    classed = kpi.courier_efficiency(views.deliveries(spark, sf), c, "courier_id", "total_distance")
    return classed.groupBy("vehicle_type", "efficiency_class").agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.sum(F.col("total_distance").cast("decimal(18,1)")).alias("total_km"),
    )


@query
def ingestion_lag(spark, sf):
    p = views.pings_batched(spark, sf)
    hour = F.date_trunc("hour", F.col("timestamp")).cast("timestamp_ntz").alias("event_hour")
    return kpi.ingestion_lag(p, hour, "timestamp", F.col("arrival_us"))


@query
def ingestion_lag_folds(spark, sf):
    """The same from states of four arrival rounds, folded as they are stored."""
    p = views.pings_batched(spark, sf)
    hour = F.date_trunc("hour", F.col("timestamp")).cast("timestamp_ntz").alias("event_hour")
    stored = live.lag_table(spark, scratch(spark, "lags"))
    for n, part in enumerate(_in_parts(p, "batch")):
        stored.put(kpi.lag_state(part, hour, "timestamp", F.col("arrival_us")), n)
        if n == 2:
            stored.fold(n)
    return kpi.read_lags(stored.read())


@query
def demand_by_hour(spark, sf):
    return kpi.demand_by_hour(views.orders(spark, sf), "order_timestamp")


# Lateness, copies, retention.


@query
def retention_24h(spark, sf):
    p = views.pings(spark, sf).select("event_id", "courier_id", "timestamp")
    return p.where(tables.within_retention("timestamp", ntz("2024-01-30 12:00:00")))


@query
def late_data_split(spark, sf):
    p = views.pings_batched(spark, sf).select("event_id", "batch", "timestamp")
    return telemetry.late_data_split(p, "batch", "timestamp")


@query
def dedup_window(spark, sf):
    p = views.pings(spark, sf).select("event_id", "order_id", "timestamp")
    return telemetry.dedup_window(p, "order_id", "timestamp", "event_id")


# Geography and trips.


def _pings_with_base(spark, sf) -> DataFrame:
    b = views.bases(spark, sf).select("base_no", F.col("lat").alias("base_lat"), F.col("lon").alias("base_lon"))
    p = views.pings(spark, sf).withColumn("base_no", F.col("courier_id") % 25)
    return lookup(p, b, "base_no")


@query
def haversine(spark, sf):
    km = F.round(haversine_km("lat", "lon", "base_lat", "base_lon"), 6)
    return _pings_with_base(spark, sf).select("event_id", "base_no", km.alias("distance_km"))


@query
def zone_bucket(spark, sf):
    zoned = spatial.with_base_distance(views.pings(spark, sf).drop("zone_key"), F.lit(52.2297), F.lit(21.0122))
    return zoned.groupBy("zone_key").agg(F.count(F.lit(1)).alias("pings"), F.max("distance_km").alias("farthest_km"))


@query
def geofence_flag(spark, sf):
    ranges = views.couriers(spark, sf).select(F.col("courier_no").alias("courier_id"), "vehicle_range_km")
    near = spatial.with_base_distance(_pings_with_base(spark, sf).drop("zone_key"), "base_lat", "base_lon")
    flagged = lookup(near, ranges, "courier_id").withColumn(
        "outside", spatial.geofence_flag("distance_km", F.col("vehicle_range_km").cast("double"))
    )
    return flagged.select("event_id", "courier_id", "outside")


@query
def nearest_base(spark, sf):
    c = views.customers(spark, sf).select("customer_id", "lat", "lon")
    return spatial.nearest_base(c, views.bases(spark, sf), "base_no").select("customer_id", "base_no", "distance_km")


@query
def bbox_join(spark, sf):
    c = views.customers(spark, sf).select("customer_id", "lat", "lon")
    return spatial.count_in_box(views.bases(spark, sf), "base_no", c)


@query
def sample_one_per_group(spark, sf):
    """One customer near each base, drawn by a seeded hash."""
    c = views.customers(spark, sf).select("customer_id", "lat", "lon")
    near = spatial.pairs_in_box(views.bases(spark, sf), "base_no", c)
    return spatial.sample_one_per_group(near, "base_no", "customer_id", "7")


@query
def trip_odometer(spark, sf):
    return telemetry.trip_totals(views.pings(spark, sf).where(clean.has_position()), "timestamp")


@query
def trip_odometer_running(spark, sf):
    p = views.pings(spark, sf).where(clean.has_position())
    narrow = p.select("event_id", "courier_id", "order_id", "timestamp", "status_key", "lat", "lon")
    metered = telemetry.trip_odometer(narrow, "timestamp", status="status_key")
    return metered.select("event_id", "order_id", "hop_km", "odometer_km")


@query
def interpolate_position(spark, sf):
    """Where each ping's courier is after three seconds on the way back to its base."""
    p = _pings_with_base(spark, sf).where(clean.has_position())
    moved = telemetry.interpolate_position(p, "base_lat", "base_lon", F.col("speed") * 3 / 1000)
    return moved.select(
        "event_id", F.round("next_lat", 6).alias("next_lat"), F.round("next_lon", 6).alias("next_lon"), "arrived"
    )


@query
def resample_positions(spark, sf):
    """Positions of each trip at every full hour between its pings."""
    p = views.pings(spark, sf).where(clean.has_position())
    grid = telemetry.resample(p, "timestamp", "event_id", 3600)
    return grid.select("courier_id", "order_id", "at", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query
def status_transitions(spark, sf):
    return telemetry.status_transitions(views.pings(spark, sf), "status_key", "timestamp")


@query
def order_lifecycle(spark, sf):
    p = views.pings(spark, sf).select("order_id", "timestamp", "status_key", "preparation_timestamp")
    return telemetry.order_lifecycle(p, "status_key", "timestamp", ["preparation_timestamp"])


# Files and tables: written to the shared folder and read back.


def _month(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM")


def _iso(df: DataFrame) -> DataFrame:
    """Times as text, as the feeds bring them."""
    kinds = ("timestamp", "timestamp_ntz")
    return df.withColumns({n: F.date_format(n, ISO) for n, t in df.dtypes if t in kinds})


def _order_feed(spark, sf) -> DataFrame:
    o = views.orders(spark, sf).withColumn("event_type", F.lit("order_created"))
    ids = {n: F.col(n).cast("string") for n in ("order_id", "customer_id")}
    return _iso(o.withColumns(ids)).select(*schemas.ORDER_EVENT.names)


def _ping_feed(spark, sf) -> DataFrame:
    """Pings in all fields of the telemetry feed, with courier codes as ids."""
    codes = views.couriers(spark, sf).select(F.col("courier_no").alias("courier_id"), F.col("courier_id").alias("_code"))
    p = lookup(views.pings(spark, sf), codes, "courier_id")
    unknown = F.concat(F.lit("C-X-"), F.col("courier_id").cast("string"))
    feed = _iso(p).withColumns(
        {
            "courier_id": F.coalesce("_code", unknown),
            "event_type": F.lit("telemetry"),
            "event_id": F.lpad(F.col("event_id").cast("string"), 19, "0"),
            "customer_id": F.col("customer_id").cast("string"),
            "pizzeria_id": F.lit(None).cast("string"),
            "realization_percent": F.lit(0.0),
            "is_delayed_delivery": F.lit(False),
        }
    )
    return feed.select(*schemas.TELEMETRY_EVENT.names)


def _bronze_orders(spark, sf) -> str:
    path = scratch(spark, "bronze_orders")
    feed = _order_feed(spark, sf)
    quarter = F.date_trunc("quarter", F.try_to_timestamp("order_timestamp"))
    files.write_bronze(feed, path, quarter)
    return path


def _bronze_pings(spark, sf) -> str:
    path = scratch(spark, "bronze_pings")
    day = F.to_date(F.try_to_timestamp("timestamp"))
    files.write_bronze(_ping_feed(spark, sf), path, day)
    return path


def _files_per_batch(spark, path: str) -> int:
    """Files per micro-batch that make the feed arrive in about four."""
    files_in_feed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(path)
    return math.ceil(files_in_feed.select("path").count() / 4)


@query
def csv_scan_typed(spark, sf):
    path = scratch(spark, "couriers_csv")
    raw = views.couriers(spark, sf).select(*schemas.COURIER_FILE.names)
    raw.write.option("header", True).csv(path)
    return files.read_csv(spark, path, schemas.COURIER_FILE)


@query
def bronze_json_roundtrip(spark, sf):
    read = files.read_json(spark, _bronze_pings(spark, sf), schemas.TELEMETRY_EVENT)
    typed = read.withColumn("timestamp", F.try_to_timestamp("timestamp"))
    return typed.select("event_id", "order_id", "timestamp", "status_key", "lat", "lon", "speed", "zone_key", "is_outside_geofence")


def _monthly_orders(spark, sf) -> str:
    path = scratch(spark, "orders_by_month")
    cleaned = clean.clean_orders(views.orders(spark, sf), now()).withColumn("order_month", _month("order_timestamp"))
    tables.write_partitioned(cleaned, path, "order_month")
    return path


@query
def partition_scan(spark, sf):
    """Key figures of the newest month, read from its partition alone."""
    path = _monthly_orders(spark, sf)
    newest = spark.read.parquet(path).agg(F.max("order_month")).first()[0]
    return kpi.daily_kpi(files.read_partition(spark, path, "order_month", newest), now())


@query
def replace_partition(spark, sf):
    """All key figures after the newest month was replaced, twice, by doubled revenue."""
    cleaned = clean.clean_orders(views.orders(spark, sf), now())
    figures = kpi.daily_kpi(cleaned, now()).withColumn("order_month", F.date_format("order_date", "yyyy-MM"))
    path = scratch(spark, "kpi_by_month")
    tables.replace_partitions(figures, path, "order_month")
    stored = spark.read.parquet(path)
    newest = stored.agg(F.max("order_month")).first()[0]
    month = pin(files.read_partition(spark, path, "order_month", newest), "kpi_month")
    doubled = month.withColumn("total_revenue", (F.col("total_revenue") * 2).cast(kpi.MONEY))
    for _ in range(2):
        tables.replace_partitions(doubled, path, "order_month")
    return spark.read.schema(stored.schema).parquet(path)


@query
def compact_partitions(spark, sf):
    """Rows and revenue per month of a table of many small files that was compacted, added to, compacted again,
    and added to once more."""
    path = scratch(spark, "orders_small_files")
    cleaned = clean.clean_orders(views.orders(spark, sf), now()).withColumn("order_month", _month("order_timestamp"))
    table = compaction.CompactedTable(spark, path, f"{path}_compacted", "order_month")
    for part in reversed(range(3)):
        some = cleaned.where(F.pmod(F.hash("order_id"), F.lit(3)) == part)
        some.repartition(4, "order_id").write.mode("append").partitionBy("order_month").parquet(path)
        if part:
            table.compact()
    return table.read().groupBy("order_month").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("gross_revenue").cast(kpi.MONEY)).alias("revenue")
    )


@query
def live_orders_append(spark, sf):
    """The log after the finished orders, and then all orders twice, were appended."""
    o = views.orders(spark, sf)
    first = clean.live_orders_project(o.where("status = 'F'"), now())
    second = clean.live_orders_project(o, ntz("2024-02-01 00:10:00"))
    log = live.orders_table(spark, scratch(spark, "orders_log"), "year")
    for n, batch in enumerate([first, second, second]):
        log.put(live.first_of_each_order(batch), n)
    return log.read()


@query
def partition_glob(spark, sf):
    """All months of a table, found by pattern in a folder that holds other things too."""
    path = _monthly_orders(spark, sf)
    views.orders(spark, sf).write.parquet(f"{path}/_notes")
    found = files.read_partitions_by_glob(spark, path, "order_month")
    return found.groupBy("order_month").agg(F.count(F.lit(1)).alias("orders"))


# Streams: the feeds as JSON files, drained in several micro-batches, the target read back.


@query
def stream_json_ingest(spark, sf):
    bronze, out = _bronze_orders(spark, sf), scratch(spark, "ingested")
    source = files.stream_json(
        spark, bronze, schemas.ORDER_EVENT, _files_per_batch(spark, bronze), archive_to=scratch(spark, "archive")
    )
    ingest.drain_to_parquet(source, out, scratch(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(schemas.ORDER_EVENT).parquet(out)


@query
def guarded_feeds(spark, sf):
    """Order events of the feeds that are there and hold rows; a feed that does not appear in time adds nothing."""
    bronze = _bronze_orders(spark, sf)
    feeds = [bronze, f"{bronze}-of-another-city"]
    read = [files.read_json(spark, f, schemas.ORDER_EVENT) for f in feeds if files.wait_for_path(spark, f, 0.1, 0.2)]
    held = [rows for rows in read if not rows.isEmpty()]
    return functools.reduce(DataFrame.unionByName, held) if held else spark.createDataFrame([], schemas.ORDER_EVENT)


@query
def silver_orders_stream(spark, sf):
    bronze, out = _bronze_orders(spark, sf), scratch(spark, "silver_orders")
    ingest.silver_orders(
        spark, bronze, out, scratch(spark, "checkpoint"), _files_per_batch(spark, bronze), as_of=now(),
        by="order_month", derive=lambda df: df.withColumn("order_month", _month("order_timestamp")),
    ).awaitTermination()
    return spark.read.parquet(out)


@query
def silver_telemetry_stream(spark, sf):
    bronze, out = _bronze_pings(spark, sf), scratch(spark, "silver_pings")
    ingest.silver_telemetry(
        spark, bronze, out, scratch(spark, "checkpoint"), _files_per_batch(spark, bronze), as_of=now()
    ).awaitTermination()
    cols = ["event_id", "courier_id", "order_id", "timestamp", "event_date", "lat", "lon", "speed", "delivery_timestamp"]
    return spark.read.parquet(out).select(*cols)


@query
def live_fleet_stream(spark, sf):
    bronze = _bronze_pings(spark, sf)
    source = files.stream_json(spark, bronze, schemas.TELEMETRY_EVENT, _files_per_batch(spark, bronze))
    fleet = live.fleet_table(spark, scratch(spark, "live_fleet"))
    live.live_fleet(source, fleet, scratch(spark, "checkpoint"), every=None, fold_every=2).awaitTermination()
    return fleet.read()


# Some of the orders are older than a day at these times, some are not.
ORDERS_AS_OF, FACTS_AS_OF = "1995-06-17 12:00:00", "2024-01-16 00:00:00"


@query
def live_orders_stream(spark, sf):
    bronze = _bronze_orders(spark, sf)
    source = files.stream_json(spark, bronze, schemas.ORDER_EVENT, _files_per_batch(spark, bronze))
    log = live.orders_table(spark, scratch(spark, "live_orders"), "quarter")
    as_of = ntz(ORDERS_AS_OF)
    live.live_orders(source, log, scratch(spark, "checkpoint"), every=None, as_of=as_of, fold_every=2).awaitTermination()
    return live.read_orders(log, as_of).withColumn("ingestion_timestamp", now())


@query
def order_perf_stream(spark, sf):
    bronze, d = _bronze_pings(spark, sf), _keyed_dims(spark, sf)
    d = {name: pin(dim, "dimension") for name, dim in d.items()}
    source = files.stream_json(spark, bronze, schemas.TELEMETRY_EVENT, _files_per_batch(spark, bronze))
    facts = live.performance_table(spark, scratch(spark, "order_performance"))
    customers = d["customer"].withColumn("customer_id", F.col("customer_id").cast("string"))
    side = live.Dimensions(d["courier"], customers, d["status"], d["pizzeria"])
    as_of = ntz(FACTS_AS_OF)
    live.order_performance(
        source, facts, side, scratch(spark, "checkpoint"), every=None, as_of=as_of, fold_every=2
    ).awaitTermination()
    return live.read_performance(facts, as_of=as_of, keep_hours=24).drop("return_timestamp")


@query
def trip_odometer_stream(spark, sf):
    """Pings and kilometres per trip over a feed whose micro-batches cut through the trips out of order."""
    path = _feed_in_order(spark, _ping_feed(spark, sf), F.pmod(F.xxhash64("event_id"), F.lit(3)), [0, 1, 2])
    source = files.stream_json(spark, path, schemas.TELEMETRY_EVENT, 2).withColumn("timestamp", F.try_to_timestamp("timestamp"))
    table = live.odometer_table(spark, scratch(spark, "odometer"))
    live.odometer(source, table, scratch(spark, "checkpoint"), every=None, fold_every=1).awaitTermination()
    return telemetry.segment_totals(table.read())


@query
def order_perf_asof_stream(spark, sf):
    """Orders with their courier's vehicle of then. The stream reads versioned dimensions batch by batch; of the loads of the
    couriers the second arrives after the stream has ended, and the facts in its span are restated."""
    bronze, d, gold = _bronze_pings(spark, sf), _keyed_dims(spark, sf), scratch(spark, "gold")
    customers = d["customer"].withColumn("customer_id", F.col("customer_id").cast("string"))
    for name, dim in {"dim_customer": customers, "dim_order_status": d["status"], "dim_pizzeria": d["pizzeria"]}.items():
        tables.VersionedTable(spark, f"{gold}/{name}").write(dim)
    couriers, loads = tables.VersionedTable(spark, f"{gold}/dim_courier"), views.courier_snapshots(spark, sf)
    _load_couriers(couriers, [loads[0], loads[2]])
    source = files.stream_json(spark, bronze, schemas.TELEMETRY_EVENT, _files_per_batch(spark, bronze))
    policies = live.AS_OF_PERFORMANCE
    table = live.performance_table(spark, scratch(spark, "order_performance"), policies)
    live.order_performance(
        source, table, live.GoldDimensions(spark, gold), scratch(spark, "checkpoint"), every=None, policies=policies,
        fold_every=2, keep_hours=None, courier_at="order_timestamp",
    ).awaitTermination()
    facts = pin(live.read_performance(table, policies), "facts")
    _load_couriers(couriers, [loads[1]])
    changed = pin(live.restated_couriers(facts, couriers.read()), "restated")
    facts = facts.join(changed.select("order_id"), "order_id", "left_anti").unionByName(changed)
    versions = couriers.read().select("courier_key", "vehicle", "valid_from")
    return lookup(facts, versions, "courier_key").select("order_id", "order_timestamp", "courier_id", "vehicle", "valid_from")


def _feed_in_order(spark, rows: DataFrame, part: Column, parts: list) -> str:
    """A ping feed that arrives part after part, two files each, so that a micro-batch of two files is one part."""
    path = scratch(spark, "feed_in_order")
    rows = pin(rows.withColumn("_part", part), "feed")
    for value in parts:
        rows.where(F.col("_part") == value).select(*schemas.TELEMETRY_EVENT.names).repartition(2, "event_id").write.mode("append").json(path)
    return path


@query
def dedup_watermark_stream(spark, sf):
    """The feed in order of event time, cut at three dates, without events within ten minutes of the last of their order."""
    day = F.dayofmonth(F.to_date(F.try_to_timestamp("timestamp")))
    path = _feed_in_order(spark, _ping_feed(spark, sf), F.floor((day - 1) / 8), [0, 1, 2, 3])
    source = files.stream_json(spark, path, schemas.TELEMETRY_EVENT, 2)
    typed = source.select("event_id", "order_id", F.try_to_timestamp("timestamp").alias("timestamp"))
    last = live.LastSeen(spark, scratch(spark, "last_seen"), "order_id", "timestamp", "event_id", buckets=16)
    out = tables.BatchTable(spark, scratch(spark, "spaced"))
    live.spaced_events(typed, last, out, scratch(spark, "checkpoint"), fold_every=2).awaitTermination()
    return out.read().withColumn("event_id", F.col("event_id").cast("long"))


def _fleet_by_arrival(spark, sf, **more) -> DataFrame:
    """The live fleet over pings that arrive in spans of five days; the span numbers are those of the micro-batches."""
    arrivals = views.pings_batched(spark, sf).select(F.lpad(F.col("event_id").cast("string"), 19, "0").alias("event_id"), "arrival_us")
    feed = lookup(_ping_feed(spark, sf), arrivals, "event_id")
    span = F.floor(F.col("arrival_us") / FIVE_DAYS_US)
    spans = sorted(r[0] for r in feed.select(span.alias("span")).distinct().collect())
    path = _feed_in_order(spark, feed, span, spans)
    source = files.stream_json(spark, path, schemas.TELEMETRY_EVENT, 2)
    fleet = live.fleet_table(spark, scratch(spark, "live_fleet"))
    live.live_fleet(source, fleet, scratch(spark, "checkpoint"), every=None, fold_every=2, **more).awaitTermination()
    return fleet


FIVE_DAYS_US = 432_000_000_000


@query
def late_events_stream(spark, sf):
    """Events that the live fleet sets aside."""
    late = live.LateEvents(spark, scratch(spark, "late_events"), parse("timestamp"))
    _fleet_by_arrival(spark, sf, late=late)
    return late.late.read().select(F.col("event_id").cast("long").alias("event_id"), F.try_to_timestamp("timestamp").alias("timestamp"))


@query
def batch_metrics(spark, sf):
    """Pings of each micro-batch, and couriers left after the newest ping of each is taken, counted while they are written."""
    metrics = live.metrics_table(spark, scratch(spark, "metrics"))
    _fleet_by_arrival(spark, sf, metrics=metrics)
    return metrics.read().select("batch", F.col("rows_read").alias("pings"), F.col("rows_written").alias("couriers"))
