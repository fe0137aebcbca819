"""The gold tables as views, so that reports can be written in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetfold.operators.clean import enforce_types
from fleetfold.operators.merge import ORDER_PERFORMANCE, read_state
from fleetfold.operators.star import order_360
from fleetfold.plans.daily import GOLD_DIMENSIONS
from fleetfold.schemas import GOLD_TYPES
from fleetfold.sources.tables import VersionedTable
from fleetfold.storage import path_exists
from fleetfold.streaming.live import fleet_table, orders_table, performance_table


def gold_tables(spark: SparkSession, gold: str, as_of=None) -> dict[str, DataFrame]:
    """Every gold table that has been loaded, by name; ``v_order_360`` once its inputs are there."""
    found: dict[str, DataFrame | None] = {
        spec.name: VersionedTable(spark, f"{gold}/{spec.name}").read() for spec in GOLD_DIMENSIONS
    }
    fleet = fleet_table(spark, f"{gold}/live_fleet_status").read()
    found["live_fleet_status"] = None if fleet is None else fleet.drop("event_id")
    found["live_orders_log"] = orders_table(spark, f"{gold}/live_orders_log").read()
    facts = performance_table(spark, f"{gold}/fact_order_performance").read()
    found["fact_order_performance"] = None if facts is None else read_state(facts, ORDER_PERFORMANCE).drop("last_event_at")
    if path_exists(spark, f"{gold}/daily_sales_fact"):
        found["daily_sales_fact"] = spark.read.parquet(f"{gold}/daily_sales_fact")
    tables = {name: enforce_types(df, GOLD_TYPES.get(name, {})) for name, df in found.items() if df is not None}
    parts = ("fact_order_performance", "live_orders_log", "dim_courier", "dim_pizzeria", "dim_customer", "dim_order_status", "dim_delivery_zone")
    if all(p in tables for p in parts):
        tables["v_order_360"] = order_360(*[tables[p] for p in parts], as_of)
    return tables


def register_gold(spark: SparkSession, gold: str, as_of=None) -> list[str]:
    """Temporary views over the gold tables as they are now."""
    tables = gold_tables(spark, gold, as_of)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)
