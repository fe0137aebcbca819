"""The test tables seen as delivery data. Plain arithmetic only, so that both engines agree.

``SQL`` holds the same views for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold.functions.time import micros
from fleetfold.plans.joins import lookup
from fleetfold.plans.ordered import with_position

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def plus_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as courier pings, in the names of the telemetry feed."""
    events = table(spark, sf_dir, "events").selectExpr("*", r"""CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k""")
    day = "CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ)"
    return events.selectExpr(
        "event_id",
        "user_id AS courier_id",
        "concat_ws('-', user_id, replace(CAST(CAST(ts AS DATE) AS STRING), '-')) AS order_id",
        "ts AS timestamp",
        """CASE event_type WHEN 'signup' THEN 'PREPARING' WHEN 'view' THEN 'IN_REALIZATION' WHEN 'click' THEN 'AT_CUSTOMER'
           WHEN 'purchase' THEN 'DELIVERED' WHEN 'error' THEN 'CRITICAL_FAILURE' END AS status_key""",
        "k",
        "CASE WHEN k = 0 THEN 0D ELSE 52.2297D + (k - 50) * 0.002D END AS lat",
        "21.0122D + value / 2000D AS lon",
        "value AS speed",
        "value AS total_distance",
        "k >= 90 AS is_outside_geofence",
        "120D - k AS time_left_sec",
        "(100 - k) / 10D AS distance_left_km",
        "k AS customer_id",
        "CASE WHEN k % 17 <> 0 THEN CAST(k % 5 + 1 AS INT) END AS zone_key",
        f"{day} AS order_timestamp",
        f"{day} + INTERVAL 30 SECONDS AS preparation_timestamp",
        "CASE WHEN event_type = 'view' THEN ts END AS pickup_timestamp",
        "CASE WHEN event_type = 'purchase' THEN ts END AS delivery_timestamp",
        "CAST(NULL AS TIMESTAMP_NTZ) AS return_timestamp",
    )


def pings_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings with the time they arrive, and a micro-batch for each hour of arrival that has any."""
    arrived = pings(spark, sf_dir).withColumn("arrival_us", micros("timestamp") + F.col("k") * 120_000_000)
    arrived = arrived.withColumn("_hour", F.floor(F.col("arrival_us") / 3_600_000_000).cast("long"))
    batches = with_position(arrived.select("_hour").distinct(), ["_hour"], "batch")
    return lookup(arrived, batches, "_hour").drop("_hour")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400) AS order_timestamp",
        """CASE WHEN o_orderkey % 97 = 0 THEN -o_totalprice WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_totalprice END
           AS gross_revenue""",
        "CAST(o_orderkey % 8 + 8 AS DOUBLE) AS delivery_charge",
        "52.2297D AS pizzeria_lat",
        "21.0122D AS pizzeria_lon",
        "o_orderstatus AS status",
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    def after(seconds: str) -> str:
        return f"order_timestamp + make_dt_interval(0, 0, 0, {seconds})"

    return orders(spark, sf_dir).selectExpr(
        "order_id",
        "customer_id",
        "order_timestamp AS order_ts",
        f"{after('order_id % 31 + 15')} AS prep_ts",
        f"CASE WHEN order_id % 11 <> 0 THEN {after('order_id % 31 + 15 + order_id % 20')} END AS pickup_ts",
        f"CASE WHEN order_id % 13 <> 0 THEN {after('order_id * 37 % 200 + 60')} END AS delivery_ts",
        "order_id % 150 AS courier_id",
        "(order_id % 100) / 10D AS total_distance",
        "CASE WHEN order_id % 13 <> 0 THEN CAST(order_id * 37 % 200 + 60 AS DOUBLE) END AS total_time",
        """element_at(array('IDLE', 'PREPARING', 'IN_REALIZATION', 'AT_CUSTOMER', 'DELIVERED', 'RETURNING',
           'CRITICAL_FAILURE'), CAST(order_id % 7 + 1 AS INT)) AS status""",
        "CASE WHEN order_id % 17 <> 0 THEN CAST(order_id % 5 + 1 AS INT) END AS zone_key",
        "order_id % 9 = 0 AS outside_geofence",
        f"{after('order_id * 53 % 300')} AS ping_ts",
        "(order_id * 31 % 100) / 10D AS km_to_target",
    )


def couriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the courier file, plus their key and code. Some codes point to a base that is not there."""

    def pick(*values: str) -> str:
        return f"element_at(array{values}, CAST(s_suppkey % {len(values)} + 1 AS INT))"

    base = "(s_nationkey + CASE WHEN s_suppkey % 8 = 0 THEN 50 ELSE 0 END)"
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS courier_no",
        "CAST(s_suppkey AS INT) AS raw_id",
        f"concat('C-N', {base}, '-', s_suppkey) AS courier_id",
        "split_part(s_name, '#', 1) AS first_name",
        "split_part(s_name, '#', 2) AS last_name",
        f"{pick('bike', 'car', 'scooter')} AS vehicle_type",
        "concat('M', s_nationkey) AS vehicle_info",
        f"{pick('B2B', 'Full-time', 'Part-time', 'Seasonal')} AS contract_type",
        "'active' AS active_status",
        "TIMESTAMP_NTZ '2024-01-01 10:00:00' AS ingested_at",
        "'HR_System' AS source_system",
        f"concat('PIZ-N', {base}, '-001') AS pizzeria_id",
        "CAST((s_suppkey % 10) / 100 AS DECIMAL(10,4)) AS accident_risk_factor",
        "CAST((s_suppkey % 7) / 10 AS DECIMAL(10,2)) AS fatigue_resistance",
        "CAST(s_suppkey % 8 + 2 AS DECIMAL(10,2)) AS vehicle_range_km",
        f"{pick('Private', 'Company')} AS vehicle_ownership",
        f"{pick('Standard', 'Pro')} AS equipment_set",
        f"{pick('High', 'Medium', 'Low')} AS performance_level",
    )


def bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as the base file."""
    return table(spark, sf_dir, "nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS base_no",
        "n_nationkey AS raw_id",
        "concat('PIZ-N', n_nationkey, '-001') AS pizzeria_id",
        "n_name AS pizzeria_name",
        "'Warsaw' AS city",
        "concat('ul. ', n_name) AS address_raw",
        "52.13D + (n_nationkey % 5) * 0.05D AS lat",
        "20.95D + (n_nationkey div 5) * 0.08D AS lon",
        "concat('Manager ', n_name) AS manager_info",
        "TIMESTAMP_NTZ '2024-01-01 10:00:00' AS ingested_at",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the customer file."""
    return table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS INT) AS raw_id",
        "c_custkey AS customer_id",
        "c_name AS full_name",
        "concat(c_name, '@example.com') AS email",
        "'ul. Krucza' AS address_raw",
        "52.13D + (c_custkey % 200) * 0.001D AS lat",
        "20.95D + (c_custkey * 7 % 320) * 0.001D AS lon",
        "c_mktsegment AS segment_tag",
        "TIMESTAMP_NTZ '2024-01-01 10:00:00' AS ingested_at",
        "'App' AS source_system",
    )


def courier_snapshots(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """Three states of the couriers with their load times, to build a history from: at first some
    are not hired yet; then vehicles and contracts change; then other attributes, and some are absent."""
    c, key = couriers(spark, sf_dir), F.col("courier_no")

    def changed(df: DataFrame, name: str, step: int, value: str | None) -> DataFrame:
        return df.withColumn(name, F.when(key % step == 0, F.lit(value)).otherwise(F.col(name)))

    second = changed(changed(c, "vehicle_type", 7, "ebike"), "contract_type", 11, "Fixed-term")
    third = changed(changed(second, "vehicle_type", 14, "van"), "active_status", 13, "on leave")
    third = changed(changed(third, "performance_level", 17, None), "equipment_set", 19, "Cargo")
    return [
        ("2024-01-01 00:00:00", c.where(key % 10 != 9)),
        ("2024-01-11 00:00:00", second),
        ("2024-01-21 00:00:00", third.where(key % 25 != 3)),
    ]


SQL = {
    "pings": """
SELECT event_id, user_id AS courier_id, user_id || '-' || strftime(ts, '%Y%m%d') AS order_id, ts AS "timestamp",
  CASE event_type WHEN 'signup' THEN 'PREPARING' WHEN 'view' THEN 'IN_REALIZATION' WHEN 'click' THEN 'AT_CUSTOMER'
    WHEN 'purchase' THEN 'DELIVERED' WHEN 'error' THEN 'CRITICAL_FAILURE' END AS status_key,
  k, CASE WHEN k = 0 THEN 0e0 ELSE 52.2297e0 + (k - 50) * 0.002e0 END AS lat, 21.0122e0 + value / 2000e0 AS lon,
  value AS speed, value AS total_distance, k >= 90 AS is_outside_geofence, 120e0 - k AS time_left_sec,
  (100 - k) / 10e0 AS distance_left_km, k AS customer_id, CASE WHEN k % 17 <> 0 THEN k % 5 + 1 END AS zone_key,
  CAST(date_trunc('day', ts) AS TIMESTAMP) AS order_timestamp,
  CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 30 SECOND AS preparation_timestamp,
  CASE WHEN event_type = 'view' THEN ts END AS pickup_timestamp,
  CASE WHEN event_type = 'purchase' THEN ts END AS delivery_timestamp,
  CAST(NULL AS TIMESTAMP) AS return_timestamp
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "pings_batched": """
SELECT *, dense_rank() OVER (ORDER BY arrival_us // 3600000000) AS batch
FROM (SELECT *, epoch_us("timestamp") + k * 120000000 AS arrival_us FROM pings)""",
    "ords": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  o_orderdate + to_seconds(o_orderkey % 86400) AS order_timestamp,
  CASE WHEN o_orderkey % 97 = 0 THEN -o_totalprice WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_totalprice END
    AS gross_revenue,
  CAST(o_orderkey % 8 + 8 AS DOUBLE) AS delivery_charge, 52.2297e0 AS pizzeria_lat, 21.0122e0 AS pizzeria_lon,
  o_orderstatus AS status
FROM orders""",
    "deliveries": """
SELECT order_id, customer_id, order_timestamp AS order_ts,
  order_timestamp + to_seconds(order_id % 31 + 15) AS prep_ts,
  CASE WHEN order_id % 11 <> 0 THEN order_timestamp + to_seconds(order_id % 31 + 15 + order_id % 20) END AS pickup_ts,
  CASE WHEN order_id % 13 <> 0 THEN order_timestamp + to_seconds(order_id * 37 % 200 + 60) END AS delivery_ts,
  order_id % 150 AS courier_id, (order_id % 100) / 10e0 AS total_distance,
  CASE WHEN order_id % 13 <> 0 THEN CAST(order_id * 37 % 200 + 60 AS DOUBLE) END AS total_time,
  ['IDLE', 'PREPARING', 'IN_REALIZATION', 'AT_CUSTOMER', 'DELIVERED', 'RETURNING', 'CRITICAL_FAILURE']
    [order_id % 7 + 1] AS status,
  CASE WHEN order_id % 17 <> 0 THEN order_id % 5 + 1 END AS zone_key, order_id % 9 = 0 AS outside_geofence,
  order_timestamp + to_seconds(order_id * 53 % 300) AS ping_ts, (order_id * 31 % 100) / 10e0 AS km_to_target
FROM ords""",
    "couriers": """
SELECT s_suppkey AS courier_no, s_suppkey AS raw_id, 'C-N' || (s_nationkey + CASE WHEN s_suppkey % 8 = 0 THEN 50 ELSE 0 END) || '-' || s_suppkey AS courier_id,
  split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name,
  ['bike', 'car', 'scooter'][s_suppkey % 3 + 1] AS vehicle_type, 'M' || s_nationkey AS vehicle_info,
  ['B2B', 'Full-time', 'Part-time', 'Seasonal'][s_suppkey % 4 + 1] AS contract_type, 'active' AS active_status,
  TIMESTAMP '2024-01-01 10:00:00' AS ingested_at, 'HR_System' AS source_system,
  'PIZ-N' || (s_nationkey + CASE WHEN s_suppkey % 8 = 0 THEN 50 ELSE 0 END) || '-001' AS pizzeria_id, CAST((s_suppkey % 10) / 100e0 AS DOUBLE) AS accident_risk_factor,
  CAST((s_suppkey % 7) / 10e0 AS DOUBLE) AS fatigue_resistance,
  CAST(s_suppkey % 8 + 2 AS DOUBLE) AS vehicle_range_km,
  ['Private', 'Company'][s_suppkey % 2 + 1] AS vehicle_ownership,
  ['Standard', 'Pro'][s_suppkey % 2 + 1] AS equipment_set,
  ['High', 'Medium', 'Low'][s_suppkey % 3 + 1] AS performance_level
FROM supplier""",
    "bases": """
SELECT CAST(n_nationkey AS BIGINT) AS base_no, n_nationkey AS raw_id, 'PIZ-N' || n_nationkey || '-001' AS pizzeria_id,
  n_name AS pizzeria_name, 'Warsaw' AS city, 'ul. ' || n_name AS address_raw,
  52.13e0 + (n_nationkey % 5) * 0.05e0 AS lat, 20.95e0 + (n_nationkey // 5) * 0.08e0 AS lon,
  'Manager ' || n_name AS manager_info, TIMESTAMP '2024-01-01 10:00:00' AS ingested_at
FROM nation""",
    "custs": """
SELECT c_custkey AS customer_id, c_name AS full_name, c_mktsegment AS segment_tag,
  52.13e0 + (c_custkey % 200) * 0.001e0 AS lat, 20.95e0 + (c_custkey * 7 % 320) * 0.001e0 AS lon,
  'App' AS source_system
FROM customer""",
}
NEEDS = {"pings_batched": ["pings"], "deliveries": ["ords"]}


def with_views(body: str, *names: str) -> str:
    """``body`` behind the named views as common table expressions."""
    wanted: list[str] = []
    for name in names:
        for n in [*NEEDS.get(name, []), name]:
            if n not in wanted:
                wanted.append(n)
    ctes = ",\n".join(f"{n} AS ({SQL[n]})" for n in wanted)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
