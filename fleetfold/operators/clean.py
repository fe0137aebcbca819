"""Cleaning and typing of events, and the projections that feed the live tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fleetfold.functions.delivery import is_finished
from fleetfold.functions.time import col, instant, parse, whole_seconds_between


def enforce_types(df: DataFrame, types: dict[str, str], safe: bool = False) -> DataFrame:
    """Cast the named columns that exist; ``safe`` turns values that do not fit into null."""

    def cast(name: str) -> Column:
        if name not in types:
            return F.col(name)
        return (F.col(name).try_cast(types[name]) if safe else F.col(name).cast(types[name])).alias(name)

    return df.select(*[cast(c) for c in df.columns])


def _as_time(df: DataFrame, name: str) -> Column:
    """Feeds bring times as text; typed input passes unchanged."""
    return parse(name) if isinstance(df.schema[name].dataType, StringType) else F.col(name)


def _typed_times(df: DataFrame, names) -> DataFrame:
    return df.withColumns({n: _as_time(df, n) for n in names if n in df.columns})


def has_position(lat="lat", lon="lon") -> Column:
    """A position is known when neither coordinate is null or zero."""
    return (col(lat) != 0) & (col(lon) != 0)


MONEY = "decimal(18,2)"


def has_revenue() -> Column:
    """Revenue is known, not negative, and an amount: no NaN, and not beyond what the key figures hold."""
    revenue = F.col("gross_revenue")
    return F.coalesce((revenue >= 0) & revenue.try_cast(MONEY).isNotNull(), F.lit(False))


def clean_orders(df: DataFrame, as_of=None) -> DataFrame:
    """Typed orders with their date and load time; negative, unknown and impossible revenue is left out."""
    return (
        df.where(has_revenue())
        .withColumn("order_timestamp", _as_time(df, "order_timestamp"))
        .withColumn("order_date", F.to_date("order_timestamp"))
        .withColumn("ingestion_timestamp", instant(as_of))
    )


def clean_telemetry(
    df: DataFrame,
    as_of=None,
    event_time: str = "timestamp",
    other_times=("order_timestamp", "preparation_timestamp", "pickup_timestamp", "delivery_timestamp", "return_timestamp"),
) -> DataFrame:
    """Typed pings with their date and load time; pings without a position are left out."""
    typed = _typed_times(df.where(has_position()), (event_time, *other_times))
    return typed.withColumn("event_date", F.to_date(event_time)).withColumn("ingestion_timestamp", instant(as_of))


def live_fleet_project(df: DataFrame, event_time: str = "timestamp") -> DataFrame:
    """Pings of known couriers in the types of the live fleet table, with event id as tie-break."""
    return df.where(F.col("courier_id").isNotNull()).select(
        "courier_id",
        "order_id",
        F.col("lat").cast("decimal(10,4)").alias("current_lat"),
        F.col("lon").cast("decimal(10,4)").alias("current_lon"),
        F.col("status_key").alias("order_status"),
        _as_time(df, event_time).alias("updated_at"),
        F.col("speed").cast("decimal(10,2)").alias("speed_kmh"),
        "is_outside_geofence",
        F.col("time_left_sec").cast("decimal(10,2)").alias("time_left_sec"),
        F.col("distance_left_km").cast("decimal(10,2)").alias("distance_left_km"),
        "event_id",
    )


def live_orders_project(df: DataFrame, as_of=None) -> DataFrame:
    """Orders for the live log: money to two digits, typed event time, load time."""
    return df.select(
        "order_id",
        "customer_id",
        F.round("gross_revenue", 2).alias("gross_revenue"),
        F.round("delivery_charge", 2).alias("delivery_charge"),
        "pizzeria_lat",
        "pizzeria_lon",
        _as_time(df, "order_timestamp").alias("order_timestamp"),
        instant(as_of).alias("ingestion_timestamp"),
    )


def order_perf_project(df: DataFrame, event_time: str = "timestamp") -> DataFrame:
    """Pings as order progress: whole seconds since the order, and whether it is finished.

    Pings without a position, and those that belong to no order, are left out.
    """
    stages = ("order_timestamp", "preparation_timestamp", "pickup_timestamp", "delivery_timestamp", "return_timestamp")
    typed = _typed_times(df.where(has_position() & F.col("order_id").isNotNull()), (event_time, *stages))
    return typed.select(
        "order_id",
        "courier_id",
        "customer_id",
        "zone_key",
        "status_key",
        F.col("is_outside_geofence").alias("outside_geofence"),
        "total_distance",
        F.col(event_time).alias("gps_timestamp"),
        *stages,
        whole_seconds_between("order_timestamp", event_time).cast("double").alias("total_time"),
        is_finished("status_key").alias("is_completed"),
        "event_id",
    )
