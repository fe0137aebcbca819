"""Key figures over orders, deliveries and ingestion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetfold.functions.delivery import SLA_SECONDS, demand_factor, efficiency_class
from fleetfold.functions.time import instant, micros, seconds_between
from fleetfold.operators.clean import MONEY
from fleetfold.plans.joins import lookup

def daily_kpi(orders: DataFrame, as_of=None) -> DataFrame:
    """Revenue, fees, order count and average order value per date, in exact decimals."""
    revenue, fee = F.col("gross_revenue").try_cast(MONEY), F.col("delivery_charge").try_cast(MONEY)
    daily = orders.groupBy("order_date").agg(
        F.sum(revenue).alias("_revenue"),
        F.sum(fee).alias("_fees"),
        F.count("order_id").alias("total_orders"),
        F.count(revenue).alias("_priced"),
    )
    average = F.when(F.col("_priced") > 0, F.round(F.col("_revenue") / F.col("_priced"), 2))
    return daily.select(
        "order_date",
        F.col("_revenue").cast(MONEY).alias("total_revenue"),
        F.col("_fees").cast(MONEY).alias("total_delivery_fees"),
        "total_orders",
        average.cast(MONEY).alias("avg_order_value"),
        instant(as_of).alias("calculated_at"),
    )


def on_time_rate(
    deliveries: DataFrame, by: list[str], order_ts: str, delivery_ts: str, limit_seconds: float = SLA_SECONDS
) -> DataFrame:
    """Share of all orders delivered within the limit, in percent; undelivered orders count as not."""
    in_time = F.coalesce((seconds_between(order_ts, delivery_ts) <= F.lit(float(limit_seconds))).cast("int"), F.lit(0))
    return deliveries.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(in_time).alias("on_time_orders"),
        F.round(F.sum(in_time) * 100.0 / F.count(F.lit(1)), 4).alias("on_time_rate"),
    )


def courier_efficiency(deliveries: DataFrame, couriers: DataFrame, key: str, distance: str) -> DataFrame:
    """Deliveries with the efficiency class of their vehicle and distance."""
    others = [c for c in deliveries.columns if c != key]
    with_vehicle = lookup(deliveries, couriers.select(key, "vehicle_type"), key, spread_by=others)
    return with_vehicle.withColumn("efficiency_class", efficiency_class("vehicle_type", distance))


def ingestion_lag(events: DataFrame, by: Column, event_ts: str, arrival_micros: Column, share: float = 0.95) -> DataFrame:
    """Average, greatest and percentile lag in whole seconds per group.

    The percentile is exact. Rows are first counted per (group, second of lag) on the map side, so
    what reaches one task is a group's distinct lags and not its rows.
    """
    lag = F.floor((arrival_micros - micros(event_ts)) / F.lit(1_000_000)).cast("long")
    counts = events.groupBy(by, lag.alias("lag")).agg(F.count(F.lit(1)).alias("n"))
    group = [c for c in counts.columns if c not in ("lag", "n")]
    ranked = counts.withColumn("_upto", F.sum("n").over(Window.partitionBy(*group).orderBy("lag"))).withColumn(
        "_all", F.sum("n").over(Window.partitionBy(*group))
    )
    reached = F.when(F.col("_upto") >= F.ceil(F.col("_all") * F.lit(share)), F.col("lag"))
    return ranked.groupBy(*group).agg(
        F.sum("n").alias("events"),
        F.round(F.sum(F.col("lag") * F.col("n")).cast("double") / F.sum("n"), 4).alias("avg_lag_sec"),
        F.max("lag").alias("max_lag_sec"),
        F.min(reached).alias("p95_lag_sec"),
    )


# The same as folds: what a group's lags come to, in a form that merges.

SKETCH_K = 800  # quantiles are exact below so many values of a group, and within half a percent of rank beyond


def lag_state(events: DataFrame, by: Column, event_ts: str, arrival_micros: Column, k: int = SKETCH_K) -> DataFrame:
    """Per group the number, sum and maximum of lags in whole seconds and a quantile sketch of bounded size."""
    lag = F.floor((arrival_micros - micros(event_ts)) / F.lit(1_000_000)).cast("long")
    return events.select(by, lag.alias("_lag")).groupBy(*events.select(by).columns).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_lag").alias("sum_lag"), F.max("_lag").alias("max_lag"),
        F.kll_sketch_agg_bigint("_lag", k).alias("sketch"),
    )


def merge_lags(states: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """States of one group -> one state."""
    group = [c for c in states.columns if c not in ("n", "sum_lag", "max_lag", "sketch")]
    return states.groupBy(*group).agg(
        F.sum("n").alias("n"), F.sum("sum_lag").alias("sum_lag"), F.max("max_lag").alias("max_lag"),
        F.kll_merge_agg_bigint("sketch", k).alias("sketch"),
    )


def read_lags(states: DataFrame, share: float = 0.95) -> DataFrame:
    """The columns of ``ingestion_lag`` from states; the percentile is that of the sketch."""
    group = [c for c in states.columns if c not in ("n", "sum_lag", "max_lag", "sketch")]
    return states.select(
        *group,
        F.col("n").alias("events"),
        F.round(F.col("sum_lag").cast("double") / F.col("n"), 4).alias("avg_lag_sec"),
        F.col("max_lag").alias("max_lag_sec"),
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(share)).alias("p95_lag_sec"),
    )


def demand_by_hour(orders: DataFrame, ts: str) -> DataFrame:
    """Orders per hour of day, and their count over the expected activity of that hour."""
    hourly = orders.groupBy(F.hour(ts).alias("hour")).agg(F.count(F.lit(1)).alias("orders"))
    return hourly.withColumn("demand_factor", demand_factor("hour")).withColumn(
        "normalised_orders", F.round(F.col("orders") / F.col("demand_factor"), 4)
    )
