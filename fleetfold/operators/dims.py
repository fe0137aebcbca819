"""Dimensions: shaping of the dimension files, literal dimensions, the date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold.functions.time import col, fixed_instant

# Delivery zones and order statuses.
ZONES = """
VALUES
  (1, 'Zone 1', 'Ultra-Urban (Center)', 0.85),
  (2, 'Zone 2', 'Urban', 0.60),
  (3, 'Zone 3', 'Residential', 0.35),
  (4, 'Zone 4', 'Suburban', 0.15),
  (5, 'Zone 5', 'Rural/Outskirts', 0.05)
  AS zones(zone_key, zone_name, zone_type, traffic_drag)
"""
STATUSES = """
VALUES
  (1, 'IDLE', 'Inactive', false),
  (2, 'PREPARING', 'In Progress', false),
  (3, 'IN_REALIZATION', 'In Progress', false),
  (4, 'AT_CUSTOMER', 'In Progress', false),
  (5, 'DELIVERED', 'Completed', true),
  (6, 'RETURNING', 'Inactive', false),
  (7, 'CRITICAL_FAILURE', 'Terminated', true)
  AS statuses(status_key, status_name, status_category, is_final_status)
"""
SEASON_BY_MONTH = {
    12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring",
    6: "Summer", 7: "Summer", 8: "Summer", 9: "Autumn", 10: "Autumn", 11: "Autumn",
}
UNKNOWN_KEY = -1


def delivery_zones(spark: SparkSession) -> DataFrame:
    zones = spark.sql(f"SELECT * FROM {ZONES}")
    return zones.withColumn("traffic_drag", F.col("traffic_drag").cast("decimal(10,2)"))


def order_statuses(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM {STATUSES}")


def date_spine(bounds: DataFrame, first: Column | str, last: Column | str) -> DataFrame:
    """Every date from ``first`` to ``last`` of the single row in ``bounds``."""
    days = F.sequence(F.to_date(col(first)), F.to_date(col(last)), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("full_date"))


def date_range(spark: SparkSession, first: str = "2025-01-01", last: str = "2027-12-31") -> DataFrame:
    return date_spine(spark.range(1), F.lit(first), F.lit(last))


def date_attributes(dates: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Calendar attributes of ``full_date``. ``holidays`` may list the holidays as ``full_date``."""
    day, weekday, month = F.col("full_date"), F.dayofweek("full_date"), F.month("full_date")
    season = F.element_at(F.create_map(*[F.lit(x) for pair in SEASON_BY_MONTH.items() for x in pair]), month)
    if holidays is None:
        dated, is_holiday = dates, F.lit(False)
    else:
        dated = dates.join(holidays.select("full_date").distinct().withColumn("_holiday", F.lit(True)), "full_date", "left")
        is_holiday = F.coalesce("_holiday", F.lit(False))
    return dated.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        "full_date",
        F.date_format(day, "EEEE").alias("day_name"),
        weekday.alias("day_of_week"),
        F.date_format(day, "MMMM").alias("month_name"),
        month.alias("month_number"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter"),
        F.year(day).alias("year"),
        weekday.isin(1, 7).alias("is_weekend"),
        is_holiday.alias("is_holiday"),
        season.alias("season"),
    )


def _stable_share(key: Column | str, seed: int) -> Column:
    """A number in [0, 1) with two digits that depends on the key alone, so reloads agree."""
    return (F.pmod(F.xxhash64(col(key).cast("string"), F.lit(seed)), F.lit(100)) / 100).cast("decimal(10,2)")


def _first_version(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "valid_from": F.col("ingested_at").cast("timestamp"),
            "valid_to": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    )


def shape_couriers(raw: DataFrame, as_of=None) -> DataFrame:
    """Courier file -> dimension rows; the insurance runs a year from the load."""
    shaped = _first_version(raw).withColumns(
        {
            "courier_name": F.concat_ws(" ", "first_name", "last_name"),
            "vehicle": F.concat_ws(" - ", "vehicle_type", "vehicle_info"),
            "employment_status": F.col("active_status"),
            "insurance_expiry_date": F.date_add(F.to_date(fixed_instant(as_of)), 365),
            "accident_risk_factor": F.col("accident_risk_factor").cast("decimal(10,4)"),
            "fatigue_resistance": F.col("fatigue_resistance").cast("decimal(10,2)"),
            "vehicle_range_km": F.col("vehicle_range_km").cast("decimal(10,2)"),
        }
    )
    return shaped.select(
        "courier_id", "courier_name", "vehicle", "vehicle_type", "vehicle_ownership", "equipment_set",
        "performance_level", "employment_status", "contract_type", "insurance_expiry_date",
        "accident_risk_factor", "fatigue_resistance", "vehicle_range_km",
        "valid_from", "valid_to", "is_current",
    )


def shape_pizzerias(raw: DataFrame) -> DataFrame:
    """Base file -> dimension rows, with the constants the file does not bring."""
    constants = {
        "store_format": "Express",
        "operating_hours_type": "Standard",
        "kitchen_capacity_level": "High",
        "region": "PL-Main",
        "country": "Poland",
        "has_outdoor_seating": False,
    }
    factor = (F.lit(0.8) + _stable_share("pizzeria_id", 1) * F.lit(0.4)).cast("decimal(10,2)")
    shaped = _first_version(raw).withColumns(
        {
            **{name: F.lit(value) for name, value in constants.items()},
            "manager_name": F.col("manager_info"),
            "full_address": F.col("address_raw"),
            "kitchen_performance_factor": factor,
            "lat": F.col("lat").cast("decimal(10,4)"),
            "lon": F.col("lon").cast("decimal(10,4)"),
        }
    )
    return shaped.select(
        "pizzeria_id", "pizzeria_name", "store_format", "operating_hours_type", "kitchen_capacity_level",
        "manager_name", "full_address", "city", "region", "country", "has_outdoor_seating",
        "kitchen_performance_factor", "lat", "lon", "valid_from", "valid_to", "is_current",
    )


def shape_customers(raw: DataFrame) -> DataFrame:
    """Customer file -> dimension rows; e-mail, address and position are not carried over."""
    return raw.select(
        "customer_id",
        F.col("full_name").alias("customer_name"),
        F.lit("Retail").alias("customer_segment"),
        F.col("segment_tag").alias("loyalty_tier"),
        F.col("source_system").alias("acquisition_channel"),
        F.lit("App").alias("preferred_payment_method"),
        F.lit(1990).alias("birth_year"),
        F.lit("Warsaw").alias("city"),
        F.lit("00-001").alias("postal_code"),
        _stable_share("customer_id", 2).alias("dropoff_difficulty_score"),
    )


def with_unknown_member(dim: DataFrame, key: str) -> DataFrame:
    """A dimension with the member that unresolved facts refer to; all but its key is null."""
    unknown = dim.sparkSession.range(1).select(
        *[F.lit(UNKNOWN_KEY if f.name == key else None).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )
    return dim.unionByName(unknown)
