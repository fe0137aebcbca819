"""The star schema: fact keys, point-in-time lookups, the order-360 view, constraint checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetfold.functions.delivery import (
    SLA_SECONDS, average_speed_kmh, base_code_of, display_status, is_late, progress_percent,
)
from fleetfold.functions.time import seconds_between
from fleetfold.operators.dims import UNKNOWN_KEY
from fleetfold.plans.joins import lookup
from fleetfold.plans.ordered import MAX_GROUP_ROWS, group_sizes, with_running


def _key_of(dim: DataFrame, natural: str, surrogate: str, as_name: str | None = None) -> DataFrame:
    """The two key columns of a dimension; of a versioned one only the current slice."""
    current = dim.where("is_current") if "is_current" in dim.columns else dim
    return current.select(F.col(natural).alias(as_name or natural), surrogate)


def _known(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(UNKNOWN_KEY)).alias(name)


def base_by_courier_code(rows: DataFrame, dim_pizzeria: DataFrame, courier_code: str = "courier_id") -> DataFrame:
    """Add the key of the base that the courier's code points to, null where there is none."""
    bases = _key_of(dim_pizzeria, "pizzeria_id", "pizzeria_key", "_base_code")
    coded = rows.withColumn("_base_code", base_code_of(courier_code))
    return lookup(coded, bases, "_base_code", spread_by=[courier_code]).drop("_base_code")


def fact_keys(
    rows: DataFrame, dim_courier: DataFrame, dim_customer: DataFrame, dim_status: DataFrame, dim_pizzeria: DataFrame,
    courier_at: str | None = None,
) -> DataFrame:
    """Order progress with natural keys -> fact rows with surrogate keys, -1 for unknown members.

    Natural keys are unique in the (current) dimensions, so every fact row stays exactly once. Only
    the literal status table of seven rows is broadcast outright, the others are joined by size. With ``courier_at``,
    a time column, the courier is the version of then and not the current one, and its code stays as ``courier_id``.
    """
    statuses = _key_of(dim_status.withColumnRenamed("status_key", "_status_key"), "status_name", "_status_key", "status_key")
    keyed = base_by_courier_code(rows, dim_pizzeria)
    if courier_at is None:
        keyed = lookup(keyed, _key_of(dim_courier, "courier_id", "courier_key"), "courier_id", spread_by=["order_id"])
    else:
        keyed = as_of_join(keyed, dim_courier, "courier_id", courier_at, ["courier_key"])
    keyed = lookup(keyed, _key_of(dim_customer, "customer_id", "customer_key"), "customer_id", spread_by=["order_id"])
    keyed = lookup(keyed, F.broadcast(statuses), "status_key")
    replaced = {"customer_id", "status_key", "zone_key"} | ({"courier_id"} if courier_at is None else set())
    own = [c for c in rows.columns if c not in replaced]
    return keyed.select(
        _known("courier_key"),
        _known("pizzeria_key"),
        _known("customer_key"),
        F.coalesce("_status_key", F.lit(UNKNOWN_KEY)).alias("status_key"),
        _known("zone_key"),
        F.date_format("order_timestamp", "yyyyMMdd").cast("int").alias("date_key"),
        *own,
    )


MAX_VERSIONS_PER_KEY = 200


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    columns: list[str],
    max_versions: int = MAX_VERSIONS_PER_KEY,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Each fact once, with the dimension version valid at its time; null if none is.

    One rule whatever the size: of the versions that began at or before the time the one that began last
    decides (of those that began together an open one, then the one that ends last), and it counts if the
    time lies before its end. So of overlapping versions a fact meets one.

    While no key has many versions they are gathered per key and looked up as one row. Otherwise facts and
    versions are put in one order of time per key and each fact takes the last version before it, so that the
    work stays linear whatever the key.
    """
    version = F.struct(
        F.col("valid_from").alias("begin"), F.col("valid_to").isNull().alias("open"), F.col("valid_to").alias("end"), *columns
    )
    dated = versions.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull())

    def picked(last: str, time: Column) -> list[Column]:
        valid = F.col(f"{last}.open") | (time < F.col(f"{last}.end"))
        return [F.when(valid, F.col(f"{last}.{c}")).alias(c) for c in columns]

    largest, _ = group_sizes(dated, [key])
    if largest <= max_versions:
        per_key = dated.groupBy(F.col(key).alias("_key")).agg(F.collect_list(version).alias("_versions"))
        joined = lookup(facts, per_key, F.col(key) == F.col("_key"))
        last = F.array_max(F.filter("_versions", lambda v: v["begin"] <= F.col(at)))
        return joined.withColumn("_last", last).select(*facts.columns, *picked("_last", F.col(at)))

    marks = dated.select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"), F.xxhash64(version).alias("_tie"),
        version.alias("_version"),
    )
    fact = F.struct(*facts.columns)
    rows = facts.select(
        F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.xxhash64(fact).alias("_tie"), fact.alias("_fact")
    )
    merged = marks.unionByName(rows, allowMissingColumns=True)
    # Rows that agree in all four are repeated facts or versions, for which a maximum needs no order.
    ordered = with_running(merged, ["_key"], ["_at", "_kind", "_tie"], {"_last": ("max", "_version")}, max_group_rows)
    known = F.when(F.col("_key").isNotNull() & F.col("_at").isNotNull(), F.col("_last"))
    return ordered.where("_kind = 1").withColumn("_last", known).select("_fact.*", *picked("_last", F.col("_at")))


def restated(
    facts: DataFrame, versions: DataFrame, key: str, at: str, columns: list[str], unknown: dict | None = None, changed: DataFrame | None = None
) -> DataFrame:
    """Facts whose ``columns`` differ from what the versions now say of their time, with the new values.

    After a version has come late these are the facts in its span and no others. ``changed`` names the keys (one column)
    whose history has changed, so that facts of other keys are not looked up. ``unknown`` gives values for facts
    that meet no version.
    """
    if changed is not None:
        facts = facts.join(changed.distinct(), key, "left_semi")
    held = facts.withColumnsRenamed({c: f"_was_{c}" for c in columns})
    now = as_of_join(held, versions, key, at, columns)
    now = now.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in (unknown or {}).items()})
    differ = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_was_{c}")) for c in columns])
    return now.where(differ).select(*facts.columns)


def courier_with_base(couriers: DataFrame, bases: DataFrame, on: str = "pizzeria_id") -> DataFrame:
    """Couriers with their home base; columns both sides have get the prefix ``base_``."""
    shared = {c: f"base_{c}" for c in bases.columns if c in couriers.columns and c != on}
    return lookup(couriers, bases.withColumnsRenamed(shared), on, "inner")


def order_360(
    fact: DataFrame,
    live_orders: DataFrame,
    dim_courier: DataFrame,
    dim_pizzeria: DataFrame,
    dim_customer: DataFrame,
    dim_status: DataFrame,
    dim_zone: DataFrame,
    as_of=None,
    sla_seconds: float = SLA_SECONDS,
) -> DataFrame:
    """One row per order with everything a report needs, dimensions resolved and metrics derived."""
    money = live_orders.select("order_id", "gross_revenue", "delivery_charge")
    wide = lookup(fact, money, "order_id")
    wide = lookup(wide, dim_courier.select("courier_key", "courier_name", "vehicle"), "courier_key", spread_by=["order_id"])
    wide = lookup(wide, dim_pizzeria.select("pizzeria_key", "pizzeria_name"), "pizzeria_key", spread_by=["order_id"])
    wide = lookup(wide, dim_customer.select("customer_key", "customer_name"), "customer_key", spread_by=["order_id"])
    wide = lookup(wide, F.broadcast(dim_status.select("status_key", "status_name")), "status_key")
    wide = lookup(wide, F.broadcast(dim_zone.select("zone_key", "zone_name")), "zone_key")
    nothing = F.lit(0).cast("decimal(10,2)")
    return wide.select(
        "order_id",
        "courier_name",
        F.col("vehicle").alias("vehicle_type"),
        "pizzeria_name",
        "customer_name",
        F.col("status_name").alias("raw_status"),
        "zone_name",
        progress_percent("status_name", "pickup_timestamp", as_of, sla_seconds).alias("realization_percent"),
        display_status("status_name").alias("simple_order_status"),
        "order_timestamp",
        "preparation_timestamp",
        "pickup_timestamp",
        "delivery_timestamp",
        seconds_between("order_timestamp", "preparation_timestamp").alias("preparation_time_sec"),
        seconds_between("preparation_timestamp", "pickup_timestamp").alias("pizza_idle_time_sec"),
        F.col("total_time").alias("total_time_sec"),
        average_speed_kmh("total_distance", "total_time").alias("average_speed_kmh"),
        "outside_geofence",
        is_late("total_time", sla_seconds).alias("delayed_delivery"),
        F.coalesce("gross_revenue", nothing).alias("gross_revenue"),
        F.coalesce("delivery_charge", nothing).alias("delivery_charge"),
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count: violations of a primary key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphans(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Facts whose key is set but has no dimension row: violations of a foreign key."""
    keyed = dim.select(F.col(dim_key).alias(fact_key))
    return facts.where(F.col(fact_key).isNotNull()).join(keyed, fact_key, "left_anti")
