"""Declared schemas of the feeds and tables. Every field may be null."""

from __future__ import annotations

from pyspark.sql.types import StructType


def _schema(fields: str) -> StructType:
    """``name type, ...`` to a schema, without needing a session."""
    schema = StructType()
    for field in fields.split(", "):
        schema.add(*field.split(" "))
    return schema


# Fixed formats: field names and types of the two event feeds and the three dimension files.
ORDER_EVENT = _schema(
    "event_type string, order_id string, customer_id string, order_timestamp string,"
    " gross_revenue double, delivery_charge double, pizzeria_lat double, pizzeria_lon double"
)
TELEMETRY_EVENT = _schema(
    "event_type string, event_id string, status_key string, courier_id string, pizzeria_id string,"
    " timestamp string, lat double, lon double, speed double, realization_percent double,"
    " zone_key integer, is_outside_geofence boolean, is_delayed_delivery boolean, time_left_sec double,"
    " distance_left_km double, total_distance double, order_id string, customer_id string,"
    " order_timestamp string, preparation_timestamp string, pickup_timestamp string,"
    " delivery_timestamp string, return_timestamp string"
)
COURIER_FILE = _schema(
    "raw_id integer, courier_id string, first_name string, last_name string, vehicle_type string,"
    " vehicle_info string, contract_type string, active_status string, ingested_at timestamp,"
    " source_system string, pizzeria_id string, accident_risk_factor decimal(10,4),"
    " fatigue_resistance decimal(10,2), vehicle_range_km decimal(10,2), vehicle_ownership string,"
    " equipment_set string, performance_level string"
)
CUSTOMER_FILE = _schema(
    "raw_id integer, customer_id string, full_name string, email string, address_raw string, lat double,"
    " lon double, segment_tag string, ingested_at timestamp, source_system string"
)
PIZZERIA_FILE = _schema(
    "raw_id integer, pizzeria_id string, pizzeria_name string, city string, address_raw string, lat double,"
    " lon double, manager_info string, ingested_at timestamp"
)

# Fixed formats: column types of the gold tables, used to cast what is loaded into them.
GOLD_TYPES: dict[str, dict[str, str]] = {
    "dim_courier": {
        "insurance_expiry_date": "date",
        "accident_risk_factor": "decimal(10,4)",
        "fatigue_resistance": "decimal(10,2)",
        "vehicle_range_km": "decimal(10,2)",
        "valid_from": "timestamp",
        "valid_to": "timestamp",
        "is_current": "boolean",
    },
    "dim_pizzeria": {
        "has_outdoor_seating": "boolean",
        "kitchen_performance_factor": "decimal(10,2)",
        "lat": "decimal(10,4)",
        "lon": "decimal(10,4)",
        "valid_from": "timestamp",
        "valid_to": "timestamp",
        "is_current": "boolean",
    },
    "dim_customer": {"birth_year": "int", "dropoff_difficulty_score": "decimal(10,2)"},
    "dim_delivery_zone": {"zone_key": "int", "traffic_drag": "decimal(10,2)"},
    "dim_order_status": {"status_key": "int", "is_final_status": "boolean"},
    "dim_date": {"date_key": "int", "full_date": "date"},
    "live_fleet_status": {
        "current_lat": "decimal(10,4)",
        "current_lon": "decimal(10,4)",
        "speed_kmh": "decimal(10,2)",
        "time_left_sec": "decimal(10,2)",
        "distance_left_km": "decimal(10,2)",
    },
    "live_orders_log": {
        "gross_revenue": "decimal(10,2)",
        "delivery_charge": "decimal(10,2)",
        "pizzeria_lat": "decimal(10,4)",
        "pizzeria_lon": "decimal(10,4)",
    },
    "fact_order_performance": {"total_distance": "decimal(10,2)", "total_time": "decimal(10,2)"},
    "daily_sales_fact": {
        "total_revenue": "decimal(18,2)",
        "total_delivery_fees": "decimal(18,2)",
        "total_orders": "bigint",
        "avg_order_value": "decimal(18,2)",
    },
}
