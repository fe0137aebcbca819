"""The queries of ``queries.py`` in SQL for DuckDB, written independently of the operators."""

from __future__ import annotations

from fleetfold.catalog.views import with_views

NOW = "TIMESTAMP '2024-02-01 00:00:00'"
MONEY = "DECIMAL(18,2)"
POSITION = "lat <> 0 AND lon <> 0"

KM = (
    "2e0 * 6371e0 * atan2(sqrt({a}), sqrt(1 - {a}))".replace(
        "{a}",
        "least(greatest(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        " + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2), 0e0), 1e0)",
    )
)


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return KM.format(lat1=lat1, lon1=lon1, lat2=lat2, lon2=lon2)


ZONE = "CASE WHEN {d} < 1.5 THEN 1 WHEN {d} < 3 THEN 2 WHEN {d} < 5 THEN 3 WHEN {d} < 8 THEN 4 ELSE 5 END"
RELABEL = """CASE {s} WHEN 'PREPARING' THEN 'KITCHEN_PREP' WHEN 'IN_REALIZATION' THEN 'ON_ROUTE'
  WHEN 'AT_CUSTOMER' THEN 'AT_DOOR' WHEN 'DELIVERED' THEN 'COMPLETED' WHEN 'RETURNING' THEN 'COMPLETED'
  WHEN 'CRITICAL_FAILURE' THEN 'ISSUE' ELSE 'PENDING' END"""
PROGRESS = """CASE WHEN {s} IN ('DELIVERED', 'RETURNING') THEN 100e0 WHEN {s} = 'AT_CUSTOMER' THEN 99e0
  WHEN {s} = 'IN_REALIZATION' AND {p} IS NOT NULL
    THEN least(95e0, round((epoch_us({at}) - epoch_us({p})) / 1e6 / 120 * 100, 2))
  WHEN {s} = 'PREPARING' THEN 10e0 ELSE 0e0 END"""
SPEED = "CASE WHEN {t} > 0 THEN round({d} / ({t} / 3600), 2) ELSE 0e0 END"

ZONES = """zones(zone_key, zone_name, zone_type, traffic_drag) AS (VALUES (1, 'Zone 1', 'Ultra-Urban (Center)', 0.85e0),
  (2, 'Zone 2', 'Urban', 0.60e0), (3, 'Zone 3', 'Residential', 0.35e0), (4, 'Zone 4', 'Suburban', 0.15e0),
  (5, 'Zone 5', 'Rural/Outskirts', 0.05e0))"""
STATUSES = """statuses(status_key, status_name, status_category, is_final_status) AS (VALUES (1, 'IDLE', 'Inactive', false),
  (2, 'PREPARING', 'In Progress', false), (3, 'IN_REALIZATION', 'In Progress', false),
  (4, 'AT_CUSTOMER', 'In Progress', false), (5, 'DELIVERED', 'Completed', true), (6, 'RETURNING', 'Inactive', false),
  (7, 'CRITICAL_FAILURE', 'Terminated', true))"""

CLEAN_ORDERS = "SELECT *, CAST(order_timestamp AS DATE) AS order_date FROM ords WHERE gross_revenue >= 0"
KPI = f"""SELECT order_date, CAST(sum(CAST(gross_revenue AS {MONEY})) AS DOUBLE) AS total_revenue,
  CAST(sum(CAST(delivery_charge AS {MONEY})) AS DOUBLE) AS total_delivery_fees, count(order_id) AS total_orders,
  CAST((2 * CAST(sum(CAST(gross_revenue AS {MONEY})) * 100 AS HUGEINT) + count(gross_revenue))
    // (2 * count(gross_revenue)) AS DOUBLE) / 100 AS avg_order_value,
  {NOW} AS calculated_at FROM cleaned GROUP BY order_date"""

COURIER_DIM = f"""SELECT courier_id, concat_ws(' ', first_name, last_name) AS courier_name,
  concat_ws(' - ', vehicle_type, vehicle_info) AS vehicle, vehicle_type, vehicle_ownership, equipment_set,
  performance_level, active_status AS employment_status, contract_type, DATE '2025-01-31' AS insurance_expiry_date,
  accident_risk_factor, fatigue_resistance, vehicle_range_km, ingested_at AS valid_from,
  CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current FROM couriers"""

FACTS = """facts AS (
  SELECT d.*, coalesce(c.courier_no + 1000, -1) AS courier_key, coalesce(b.base_no + 500, -1) AS pizzeria_key,
    coalesce(k.customer_id + 1, -1) AS customer_key, coalesce(s.status_key, -1) AS status_key,
    coalesce(d.zone_key, -1) AS zone_no, CAST(strftime(order_ts, '%Y%m%d') AS BIGINT) AS date_key
  FROM deliveries d LEFT JOIN couriers c ON c.courier_no = d.courier_id
  LEFT JOIN bases b ON b.pizzeria_id = 'PIZ-' || split_part(c.courier_id, '-', 2) || '-001'
  LEFT JOIN custs k ON k.customer_id = d.customer_id LEFT JOIN statuses s ON s.status_name = d.status)"""

SNAPSHOTS = """snap1 AS (SELECT * FROM couriers WHERE courier_no % 10 <> 9),
snap2 AS (SELECT * REPLACE (CASE WHEN courier_no % 7 = 0 THEN 'ebike' ELSE vehicle_type END AS vehicle_type,
  CASE WHEN courier_no % 11 = 0 THEN 'Fixed-term' ELSE contract_type END AS contract_type) FROM couriers),
snap3 AS (SELECT * REPLACE (CASE WHEN courier_no % 14 = 0 THEN 'van' ELSE vehicle_type END AS vehicle_type,
  CASE WHEN courier_no % 13 = 0 THEN 'on leave' ELSE active_status END AS active_status,
  CASE WHEN courier_no % 17 <> 0 THEN performance_level END AS performance_level,
  CASE WHEN courier_no % 19 = 0 THEN 'Cargo' ELSE equipment_set END AS equipment_set)
  FROM snap2 WHERE courier_no % 25 <> 3)"""


def _shaped(snapshot: str) -> str:
    return f"""SELECT courier_id, vehicle_type, concat_ws(' ', first_name, last_name) AS courier_name,
  concat_ws(' - ', vehicle_type, vehicle_info) AS vehicle, vehicle_ownership, equipment_set, performance_level,
  active_status AS employment_status, contract_type, accident_risk_factor, fatigue_resistance, vehicle_range_km
FROM {snapshot}"""


def _history() -> str:
    """Three loads by the rule: close what changed, open what is new or changed, number after the highest."""
    tracked = (
        "courier_name, vehicle, vehicle_ownership, equipment_set, performance_level, employment_status, contract_type, "
        "accident_risk_factor, fatigue_resistance, vehicle_range_km"
    )
    cols = f"courier_id, vehicle_type, {tracked}"
    parts = [f"""h1 AS (SELECT {cols}, TIMESTAMP '2024-01-01' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
  true AS is_current, row_number() OVER (ORDER BY courier_id) AS courier_key FROM ({_shaped('snap1')}))"""]
    for n, day in ((2, "2024-01-11"), (3, "2024-01-21")):
        differs = " OR ".join(f"h.{c} IS DISTINCT FROM s.{c}" for c in tracked.split(", "))
        h_cols = ", ".join(f"h.{c}" for c in cols.split(", "))
        parts.append(f"""s{n} AS ({_shaped(f'snap{n}')}),
c{n} AS (SELECT {h_cols}, h.valid_from,
    CASE WHEN h.is_current AND s.courier_id IS NOT NULL AND ({differs}) THEN TIMESTAMP '{day}' ELSE h.valid_to END AS valid_to,
    h.is_current AND NOT coalesce(s.courier_id IS NOT NULL AND ({differs}), false) AS is_current, h.courier_key
  FROM h{n - 1} h LEFT JOIN s{n} s ON s.courier_id = h.courier_id),
h{n} AS (SELECT * FROM c{n} UNION ALL
  SELECT {cols}, TIMESTAMP '{day}', NULL, true,
    (SELECT max(courier_key) FROM c{n}) + row_number() OVER (ORDER BY courier_id)
  FROM s{n} WHERE courier_id NOT IN (SELECT courier_id FROM c{n} WHERE is_current))""")
    return ",\n".join(parts)


HISTORY = f"{SNAPSHOTS},\n{_history()}"

LATEST_OF_FLEET = """SELECT {id} AS courier_id, order_id, CAST(CAST(CAST(lat AS VARCHAR) AS DECIMAL(10,4)) AS DOUBLE) AS current_lat,
  CAST(CAST(CAST(lon AS VARCHAR) AS DECIMAL(10,4)) AS DOUBLE) AS current_lon, status_key AS order_status, "timestamp" AS updated_at,
  CAST(CAST(CAST(speed AS VARCHAR) AS DECIMAL(10,2)) AS DOUBLE) AS speed_kmh, is_outside_geofence,
  CAST(CAST(time_left_sec AS DECIMAL(10,2)) AS DOUBLE) AS time_left_sec,
  CAST(CAST(distance_left_km AS DECIMAL(10,2)) AS DOUBLE) AS distance_left_km, {event} AS event_id
FROM {source}"""

PROGRESS_ROWS = f"""SELECT order_id, courier_id, customer_id, zone_key, status_key,
  is_outside_geofence AS outside_geofence, total_distance, "timestamp" AS gps_timestamp, order_timestamp,
  preparation_timestamp, pickup_timestamp, delivery_timestamp,
  CAST(epoch_us(date_trunc('second', "timestamp")) // 1000000 - epoch_us(order_timestamp) // 1000000 AS DOUBLE) AS total_time,
  status_key IN ('DELIVERED', 'RETURNING') AS is_completed, event_id
FROM pings WHERE {POSITION}"""


def _fold(source: str) -> str:
    by = "ORDER BY gps_timestamp, event_id"
    return f"""SELECT order_id, {', '.join(f'first({c} {by}) AS {c}' for c in ('customer_id', 'zone_key', 'order_timestamp'))},
  {', '.join(f'last({c} {by}) AS {c}' for c in ('courier_id', 'status_key', 'outside_geofence', 'is_completed'))},
  {', '.join(f'last({c} {by}) FILTER (WHERE {c} IS NOT NULL) AS {c}'
             for c in ('preparation_timestamp', 'pickup_timestamp', 'delivery_timestamp'))},
  max(total_distance) AS total_distance, max(total_time) AS total_time, max(gps_timestamp) AS last_event_at
FROM {source} GROUP BY order_id"""


ALLOWED = """allowed(a, b) AS (VALUES ('IDLE', 'PREPARING'), ('PREPARING', 'IN_REALIZATION'), ('IN_REALIZATION', 'AT_CUSTOMER'),
  ('AT_CUSTOMER', 'DELIVERED'), ('DELIVERED', 'RETURNING'), ('RETURNING', 'IDLE'), ('PREPARING', 'CRITICAL_FAILURE'),
  ('IN_REALIZATION', 'CRITICAL_FAILURE'), ('AT_CUSTOMER', 'CRITICAL_FAILURE'), ('DELIVERED', 'CRITICAL_FAILURE'),
  ('IDLE', 'IDLE'), ('PREPARING', 'PREPARING'), ('IN_REALIZATION', 'IN_REALIZATION'), ('AT_CUSTOMER', 'AT_CUSTOMER'),
  ('RETURNING', 'RETURNING'))"""

SPANS = """spans AS (SELECT *, dense_rank() OVER (ORDER BY arrival_us // 432000000000) - 1 AS span FROM pings_batched)"""

PINGS_WITH_BASE = """based AS (SELECT p.*, b.base_no, b.lat AS base_lat, b.lon AS base_lon
  FROM pings p LEFT JOIN bases b ON b.base_no = p.courier_id % 25)"""
HOPS = f"""hops AS (SELECT *, coalesce(CAST(round({km('plat', 'plon', 'lat', 'lon')}, 6) AS DECIMAL(18,6)), 0) AS hop
  FROM (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM pings WHERE {POSITION}
        WINDOW w AS (PARTITION BY courier_id, order_id ORDER BY "timestamp", event_id)))"""
CODED = """coded AS (SELECT p.* REPLACE (coalesce(c.courier_id, 'C-X-' || p.courier_id) AS courier_id,
    lpad(CAST(event_id AS VARCHAR), 19, '0') AS event_id), c.courier_no
  FROM pings p LEFT JOIN couriers c ON c.courier_no = p.courier_id)"""
ISO = "strftime({t}, '%Y-%m-%dT%H:%M:%S.%fZ')"


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}

    q["clean_orders"] = with_views(
        f"SELECT order_id, customer_id, order_timestamp, gross_revenue, delivery_charge, status, order_date, "
        f"{NOW} AS ingestion_timestamp FROM ({CLEAN_ORDERS})", "ords")
    q["clean_telemetry"] = with_views(
        f"""SELECT * EXCLUDE (return_timestamp), CAST("timestamp" AS DATE) AS event_date, {NOW} AS ingestion_timestamp
        FROM pings WHERE {POSITION}""", "pings")
    q["live_fleet_project"] = with_views(LATEST_OF_FLEET.format(id="courier_id", event="event_id", source="pings"), "pings")
    q["live_orders_project"] = with_views(
        f"""SELECT order_id, customer_id, round(gross_revenue, 2) AS gross_revenue, round(delivery_charge, 2)
        AS delivery_charge, pizzeria_lat, pizzeria_lon, order_timestamp, {NOW} AS ingestion_timestamp FROM ords""", "ords")
    q["order_perf_project"] = with_views(PROGRESS_ROWS, "pings")
    q["enforce_types"] = """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR)
        AS c_nationkey, CAST(CAST(c_acctbal AS DECIMAL(10,1)) AS DOUBLE) AS c_acctbal, c_mktsegment,
        CAST(TRY_CAST(c_mktsegment AS INTEGER) AS BIGINT) AS segment_no FROM customer"""

    date_cols = """CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS DATE) AS full_date, dayname(d) AS day_name,
        dayofweek(d) + 1 AS day_of_week, monthname(d) AS month_name, month(d) AS month_number,
        'Q' || quarter(d) AS quarter, year(d) AS year, dayofweek(d) IN (0, 6) AS is_weekend, false AS is_holiday,
        CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
          WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season"""
    spine = """spine AS (SELECT unnest(generate_series(CAST(min(order_timestamp) AS DATE)::TIMESTAMP,
        CAST(max(order_timestamp) AS DATE)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM ords)"""
    q["dim_date"] = with_views(
        f"""WITH {spine}, n AS (SELECT CAST(order_timestamp AS DATE) AS day, count(*) AS n FROM ords GROUP BY 1)
        SELECT {date_cols}, coalesce(n.n, 0) AS orders FROM spine LEFT JOIN n ON n.day = CAST(d AS DATE)""", "ords")
    q["dim_static"] = with_views(
        f"""WITH {ZONES}, {STATUSES}, n AS (SELECT status, zone_key, count(*) AS deliveries FROM deliveries GROUP BY ALL)
        SELECT s.status_name, n.zone_key, n.deliveries, s.status_key, s.status_category, s.is_final_status, z.zone_name,
          z.zone_type, z.traffic_drag
        FROM n JOIN statuses s ON s.status_name = n.status LEFT JOIN zones z ON z.zone_key = n.zone_key""", "deliveries")
    q["dim_courier_shape"] = with_views(COURIER_DIM, "couriers")
    q["dim_pizzeria_shape"] = with_views(
        """SELECT pizzeria_id, pizzeria_name, 'Express' AS store_format, 'Standard' AS operating_hours_type,
        'High' AS kitchen_capacity_level, manager_info AS manager_name, address_raw AS full_address, city,
        'PL-Main' AS region, 'Poland' AS country, false AS has_outdoor_seating,
        CAST(CAST(lat AS DECIMAL(10,4)) AS DOUBLE) AS lat, CAST(CAST(lon AS DECIMAL(10,4)) AS DOUBLE) AS lon,
        ingested_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current, true AS factor_in_range
        FROM bases""", "bases")
    q["dim_customer_shape"] = with_views(
        """SELECT customer_id, full_name AS customer_name, 'Retail' AS customer_segment, segment_tag AS loyalty_tier,
        source_system AS acquisition_channel, 'App' AS preferred_payment_method, CAST(1990 AS BIGINT) AS birth_year,
        'Warsaw' AS city, '00-001' AS postal_code, true AS score_in_range FROM custs""", "custs")
    counts = {
        "dim_courier": "SELECT count(*) + 1 FROM couriers",
        "dim_pizzeria": "SELECT count(*) + 1 FROM bases",
        "dim_customer": "SELECT count(*) + 1 FROM custs",
        "dim_delivery_zone": "SELECT count(*) + 1 FROM zones",
        "dim_order_status": "SELECT count(*) + 1 FROM statuses",
        "dim_date": "SELECT count(*) + 1 FROM spine",
    }
    q["gold_dims_load"] = with_views(
        f"WITH {ZONES}, {STATUSES}, {spine}, c AS ("
        + " UNION ALL ".join(f"SELECT '{n}' AS dimension, ({sql}) AS n" for n, sql in counts.items())
        + ") SELECT dimension, n AS rows_loaded, n AS rows_unchanged FROM c", "couriers", "bases", "custs", "ords")

    q["status_relabel"] = with_views(
        f"SELECT order_id, status, {RELABEL.format(s='status')} AS simple_order_status FROM deliveries", "deliveries")
    at = "order_ts + INTERVAL 100 SECOND"
    q["progress_percent"] = with_views(
        f"SELECT order_id, {PROGRESS.format(s='status', p='pickup_ts', at=at)} AS realization_percent FROM deliveries",
        "deliveries")
    q["avg_speed"] = with_views(
        f"SELECT order_id, {SPEED.format(t='total_time', d='total_distance')} AS average_speed_kmh FROM deliveries",
        "deliveries")
    q["sla_clock"] = with_views(
        """SELECT order_id, round(120e0 - (epoch_us(until) - epoch_us(order_ts)) / 1e6, 2) AS time_left_sec,
        coalesce(epoch_us(until) - epoch_us(order_ts) > 120000000, false) AS is_delayed
        FROM (SELECT *, CASE WHEN status IN ('DELIVERED', 'RETURNING') THEN delivery_ts ELSE ping_ts END AS until
              FROM deliveries)""", "deliveries")
    q["distance_left"] = with_views(
        """SELECT order_id, CASE status WHEN 'IN_REALIZATION' THEN km_to_target WHEN 'PREPARING' THEN total_distance
        ELSE 0e0 END AS distance_left_km FROM deliveries""", "deliveries")
    q["realization_percent"] = with_views(
        """SELECT order_id, round(CASE WHEN status IN ('DELIVERED', 'RETURNING') THEN 100e0 WHEN status = 'AT_CUSTOMER'
          THEN 99e0 WHEN status = 'IN_REALIZATION' AND total_distance > 0
          THEN least(99e0, greatest(0e0, (1 - km_to_target / total_distance) * 100)) ELSE 0e0 END, 2)
          AS realization_percent FROM deliveries""", "deliveries")
    q["speed_normalise"] = with_views(
        """SELECT event_id, CASE WHEN status_key IN ('IDLE', 'PREPARING', 'AT_CUSTOMER', 'CRITICAL_FAILURE') THEN 0e0
        ELSE round(speed * 3.6e0, 1) END AS speed_kmh FROM pings""", "pings")

    star = ("deliveries", "couriers", "bases", "custs")
    q["fact_key_lookup"] = with_views(
        f"""WITH {STATUSES}, {FACTS} SELECT order_id, courier_key, pizzeria_key, customer_key, status_key,
        zone_no AS zone_key, date_key FROM facts""", *star)
    q["computed_key_join"] = with_views(
        """SELECT d.order_id, c.courier_id AS courier_code, b.base_no + 500 AS pizzeria_key FROM deliveries d
        LEFT JOIN couriers c ON c.courier_no = d.courier_id
        LEFT JOIN bases b ON b.pizzeria_id = 'PIZ-' || split_part(c.courier_id, '-', 2) || '-001'""", *star)
    q["courier_base_join"] = with_views(
        """SELECT c.courier_id, c.pizzeria_id, b.pizzeria_name, CAST(c.raw_id AS BIGINT) AS raw_id, CAST(b.raw_id AS BIGINT)
        AS base_raw_id, b.lat, b.lon FROM couriers c JOIN bases b ON b.pizzeria_id = c.pizzeria_id""", "couriers", "bases")
    q["order_360"] = with_views(
        f"""WITH {STATUSES}, {ZONES}, {FACTS}, dc AS ({COURIER_DIM})
        SELECT f.order_id, dc.courier_name, dc.vehicle AS vehicle_type, b.pizzeria_name, k.full_name AS customer_name,
          f.status AS raw_status, z.zone_name,
          {PROGRESS.format(s='f.status', p='f.pickup_ts', at='f.' + at)} AS realization_percent,
          {RELABEL.format(s='f.status')} AS simple_order_status, f.order_ts AS order_timestamp,
          f.prep_ts AS preparation_timestamp, f.pickup_ts AS pickup_timestamp, f.delivery_ts AS delivery_timestamp,
          (epoch_us(f.prep_ts) - epoch_us(f.order_ts)) / 1e6 AS preparation_time_sec,
          (epoch_us(f.pickup_ts) - epoch_us(f.prep_ts)) / 1e6 AS pizza_idle_time_sec, f.total_time AS total_time_sec,
          {SPEED.format(t='f.total_time', d='f.total_distance')} AS average_speed_kmh, f.outside_geofence,
          coalesce(f.total_time > 120, false) AS delayed_delivery, coalesce(o.gross_revenue, 0e0) AS gross_revenue,
          coalesce(o.delivery_charge, 0e0) AS delivery_charge
        FROM facts f LEFT JOIN couriers c ON c.courier_no = f.courier_key - 1000
        LEFT JOIN dc ON dc.courier_id = c.courier_id LEFT JOIN bases b ON b.base_no = f.pizzeria_key - 500
        LEFT JOIN custs k ON k.customer_id = f.customer_key - 1 LEFT JOIN zones z ON z.zone_key = f.zone_no
        LEFT JOIN ords o ON o.order_id = f.order_id""", *star)

    q["insert_absent"] = with_views(
        f"""WITH {SNAPSHOTS} SELECT courier_id, courier_no, vehicle_type FROM snap2 s
        WHERE NOT EXISTS (SELECT 1 FROM snap1 t WHERE t.courier_id = s.courier_id)""", "couriers")
    q["surrogate_keys"] = with_views(
        "SELECT courier_id, courier_no, 100 + row_number() OVER (ORDER BY courier_id) AS courier_key FROM couriers",
        "couriers")
    q["changed_rows"] = with_views(
        f"""WITH {SNAPSHOTS} SELECT s.courier_id, s.vehicle_type FROM snap2 s JOIN snap1 t USING (courier_id)
        WHERE s.vehicle_type IS DISTINCT FROM t.vehicle_type OR s.contract_type IS DISTINCT FROM t.contract_type""", "couriers")
    q["scd1_merge"] = with_views(
        """SELECT customer_id, CASE WHEN customer_id % 5 <> 1 AND customer_id % 4 = 0 THEN full_name || ' II'
          ELSE full_name END AS full_name, segment_tag,
          CASE WHEN customer_id % 10 <> 9 THEN 'n' || customer_id END AS note
        FROM custs WHERE customer_id % 10 <> 9 OR customer_id % 5 <> 1""", "custs")
    history = f"""WITH {HISTORY} SELECT * REPLACE (CAST(valid_from AS TIMESTAMP) AS valid_from) FROM h3"""
    q["scd2_merge"] = with_views(history, "couriers")
    q["scd2_idempotent"] = q["scd2_merge"]
    q["scd2_out_of_order"] = with_views(f"SELECT * EXCLUDE (courier_key) FROM ({history})", "couriers")
    q["scd2_asof_join"] = with_views(
        f"""WITH {HISTORY} SELECT p.event_id, c.courier_id AS code, h.vehicle, CAST(h.valid_from AS TIMESTAMP) AS valid_from
        FROM pings p LEFT JOIN couriers c ON c.courier_no = p.courier_id
        LEFT JOIN h3 h ON h.courier_id = c.courier_id AND p."timestamp" >= h.valid_from
          AND (h.valid_to IS NULL OR p."timestamp" < h.valid_to)""", "couriers", "pings")
    newest = "QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY \"timestamp\" DESC, event_id DESC) = 1"
    q["latest_per_courier"] = with_views(
        "SELECT courier_id, event_id, \"timestamp\", status_key, lat, lon, speed FROM pings " + newest.format(k="courier_id"),
        "pings")
    q["latest_per_order"] = with_views(
        "SELECT order_id, event_id, \"timestamp\", status_key, total_distance FROM pings " + newest.format(k="order_id"),
        "pings")
    fleet = LATEST_OF_FLEET.format(id="courier_id", event="event_id", source="pings")
    q["live_fleet_upsert"] = with_views(f"{fleet} {newest.format(k='courier_id')}", "pings")
    q["order_perf_fold"] = with_views(f"WITH rows_ AS ({PROGRESS_ROWS}) {_fold('rows_')}", "pings")
    q["order_perf_upsert"] = q["order_perf_fold"]
    q["order_perf_reference_batching"] = with_views(
        f"""WITH rows_ AS ({PROGRESS_ROWS}),
        newest AS (SELECT r.* FROM rows_ r JOIN (SELECT event_id, batch % 4 AS round FROM pings_batched) b USING (event_id)
          QUALIFY row_number() OVER (PARTITION BY order_id, round ORDER BY gps_timestamp DESC, event_id DESC) = 1)
        {_fold('newest')}""", "pings_batched")
    q["dq_pk_duplicates"] = """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS copies
        FROM lineitem GROUP BY ALL HAVING count(*) > 1"""
    q["dq_fk_orphans"] = with_views(
        """SELECT order_id, courier_id FROM deliveries d
        WHERE NOT EXISTS (SELECT 1 FROM couriers c WHERE c.courier_no = d.courier_id)""", "deliveries", "couriers")

    q["daily_kpi"] = with_views(f"WITH cleaned AS ({CLEAN_ORDERS}) {KPI}", "ords")
    q["on_time_rate"] = with_views(
        """SELECT order_date, count(*) AS total_orders, CAST(sum(ok) AS BIGINT) AS on_time_orders,
        round(CAST(sum(ok) AS DOUBLE) * 100 / count(*), 4) AS on_time_rate
        FROM (SELECT CAST(order_ts AS DATE) AS order_date, CASE WHEN epoch_us(delivery_ts) - epoch_us(order_ts) <= 120000000
          THEN 1 ELSE 0 END AS ok FROM deliveries) GROUP BY order_date""", "deliveries")
    q["courier_efficiency"] = with_views(
        """SELECT vehicle_type, CASE WHEN upper(vehicle_type) LIKE '%BIKE%' AND total_distance < 3 THEN 'High'
          WHEN upper(vehicle_type) LIKE '%CAR%' AND total_distance < 1 THEN 'Low' ELSE 'Normal' END AS efficiency_class,
          count(*) AS deliveries, CAST(sum(CAST(total_distance AS DECIMAL(18,1))) AS DOUBLE) AS total_km
        FROM deliveries d LEFT JOIN couriers c ON c.courier_no = d.courier_id GROUP BY ALL""", "deliveries", "couriers")
    q["ingestion_lag"] = with_views(
        """SELECT CAST(date_trunc('hour', "timestamp") AS TIMESTAMP) AS event_hour, count(*) AS events,
        round(CAST(sum(lag) AS DOUBLE) / count(*), 4) AS avg_lag_sec, max(lag) AS max_lag_sec,
        quantile_disc(lag, 0.95) AS p95_lag_sec
        FROM (SELECT "timestamp", (arrival_us - epoch_us("timestamp")) // 1000000 AS lag FROM pings_batched)
        GROUP BY ALL""", "pings_batched")
    q["ingestion_lag_folds"] = q["ingestion_lag"]
    q["batch_metrics"] = with_views(
        f"WITH {SPANS} SELECT span AS batch, count(*) AS pings, count(DISTINCT courier_id) AS couriers FROM spans GROUP BY span",
        "pings_batched")
    q["late_events_stream"] = with_views(
        f"""WITH {SPANS}, m AS (SELECT span, max(epoch_us("timestamp")) AS seen FROM spans GROUP BY span),
        w AS (SELECT span, max(seen) OVER (ORDER BY span RANGE BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS seen FROM m)
        SELECT event_id, "timestamp" FROM spans JOIN w USING (span)
        WHERE epoch_us("timestamp") <= (w.seen // 1000 - 600000) * 1000""", "pings_batched")
    q["demand_by_hour"] = with_views(
        """SELECT hour, orders, factor AS demand_factor, round(orders / factor, 4) AS normalised_orders
        FROM (SELECT hour(order_timestamp) AS hour, count(*) AS orders, CASE WHEN hour(order_timestamp) < 10 THEN 0.3e0
          WHEN hour(order_timestamp) < 23 THEN 0.98e0 ELSE 0.5e0 END AS factor FROM ords GROUP BY ALL)""", "ords")

    q["retention_24h"] = with_views(
        """SELECT event_id, courier_id, "timestamp" FROM pings
        WHERE "timestamp" >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 24 HOUR""", "pings")
    q["late_data_split"] = with_views(
        """WITH m AS (SELECT batch, max(epoch_us("timestamp")) AS seen FROM pings_batched GROUP BY batch),
        w AS (SELECT batch, max(seen) OVER (ORDER BY batch RANGE BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS seen FROM m)
        SELECT event_id, batch, "timestamp", coalesce(epoch_us("timestamp") <= (w.seen // 1000 - 600000) * 1000, false)
          AS is_late FROM pings_batched JOIN w USING (batch)""", "pings_batched")
    q["dedup_window"] = with_views(
        """SELECT event_id, order_id, "timestamp" FROM (SELECT *, lag("timestamp") OVER (PARTITION BY order_id
          ORDER BY "timestamp", event_id) AS before FROM pings)
        WHERE before IS NULL OR epoch_us("timestamp") - epoch_us(before) >= 600000000""", "pings")

    q["dedup_watermark_stream"] = q["dedup_window"]

    to_base = km("lat", "lon", "base_lat", "base_lon")
    q["haversine"] = with_views(
        f"WITH {PINGS_WITH_BASE} SELECT event_id, base_no, round({to_base}, 6) AS distance_km FROM based", "pings", "bases")
    q["zone_bucket"] = with_views(
        f"""SELECT {ZONE.format(d='d')} AS zone_key, count(*) AS pings, max(d) AS farthest_km
        FROM (SELECT round({km('lat', 'lon', '52.2297e0', '21.0122e0')}, 6) AS d FROM pings) GROUP BY ALL""", "pings")
    q["geofence_flag"] = with_views(
        f"""WITH {PINGS_WITH_BASE} SELECT event_id, p.courier_id, round({to_base}, 6) > c.vehicle_range_km AS outside
        FROM based p LEFT JOIN couriers c ON c.courier_no = p.courier_id""", "pings", "bases", "couriers")
    q["nearest_base"] = with_views(
        f"""SELECT customer_id, base_no, d AS distance_km FROM (SELECT c.customer_id, b.base_no,
          round({km('c.lat', 'c.lon', 'b.lat', 'b.lon')}, 6) AS d FROM custs c CROSS JOIN bases b)
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY d, base_no) = 1""", "custs", "bases")
    box = """c.lat BETWEEN b.lat - 0.025e0 AND b.lat + 0.025e0 AND c.lon BETWEEN b.lon - 0.025e0 AND b.lon + 0.025e0"""
    q["bbox_join"] = with_views(
        f"SELECT b.base_no, count(*) AS points FROM bases b JOIN custs c ON {box} GROUP BY b.base_no", "custs", "bases")
    q["sample_one_per_group"] = with_views(
        f"""SELECT b.base_no, c.customer_id, c.lat, c.lon FROM bases b JOIN custs c ON {box}
        QUALIFY row_number() OVER (PARTITION BY b.base_no
          ORDER BY md5('7|' || b.base_no || '|' || c.customer_id), c.customer_id) = 1""", "custs", "bases")
    q["trip_odometer"] = with_views(
        f"""WITH {HOPS} SELECT courier_id, order_id, count(*) AS pings, CAST(sum(hop) AS DOUBLE) AS trip_km
        FROM hops GROUP BY ALL""", "pings")
    q["trip_odometer_stream"] = with_views(
        f"""WITH {CODED}, {HOPS.replace('FROM pings', 'FROM coded')} SELECT courier_id, order_id, count(*) AS pings,
        CAST(sum(hop) AS DOUBLE) AS trip_km FROM hops GROUP BY ALL""", "pings", "couriers")
    q["trip_odometer_running"] = with_views(
        f"""WITH {HOPS}, moving AS (SELECT * REPLACE (CASE WHEN status_key IN ('IN_REALIZATION', 'RETURNING') THEN hop
            ELSE 0 END AS hop) FROM hops)
        SELECT event_id, order_id, CAST(hop AS DOUBLE) AS hop_km, CAST(sum(hop) OVER (PARTITION BY courier_id, order_id
          ORDER BY "timestamp", event_id) AS DOUBLE) AS odometer_km FROM moving""", "pings")
    q["interpolate_position"] = with_views(
        f"""WITH {PINGS_WITH_BASE}, d AS (SELECT *, {to_base} AS d, speed * 3 / 1000e0 AS step FROM based WHERE {POSITION}),
        s AS (SELECT *, CASE WHEN d > 0 THEN least(step / d, 1e0) ELSE 1e0 END AS share FROM d)
        SELECT event_id, round(lat + (base_lat - lat) * share, 6) AS next_lat,
          round(lon + (base_lon - lon) * share, 6) AS next_lon, d <= step AS arrived FROM s""", "pings", "bases")
    q["resample_positions"] = with_views(
        f"""WITH legs AS (SELECT courier_id, order_id, epoch_us("timestamp") AS t1, lat, lon, epoch_us(lag("timestamp")
            OVER w) AS t0, lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0 FROM pings WHERE {POSITION}
          WINDOW w AS (PARTITION BY courier_id, order_id ORDER BY "timestamp", event_id)),
        ticks AS (SELECT *, unnest(range(CAST(ceil(t0 / 3600e6) AS BIGINT), CAST(ceil(t1 / 3600e6) AS BIGINT))) AS tick
          FROM legs WHERE t0 IS NOT NULL)
        SELECT courier_id, order_id, make_timestamp(tick * 3600000000) AS at,
          round(lat0 + (lat - lat0) * ((tick * 3600000000 - t0) / CAST(t1 - t0 AS DOUBLE)), 6) AS lat,
          round(lon0 + (lon - lon0) * ((tick * 3600000000 - t0) / CAST(t1 - t0 AS DOUBLE)), 6) AS lon FROM ticks""", "pings")
    q["status_transitions"] = with_views(
        f"""WITH {ALLOWED}, steps AS (SELECT status_key AS b, lag(status_key) OVER (PARTITION BY courier_id
            ORDER BY "timestamp", event_id) AS a FROM pings)
        SELECT s.a AS from_status, s.b AS to_status, count(*) AS transitions, bool_or(l.a IS NOT NULL) AS allowed
        FROM steps s LEFT JOIN allowed l ON l.a = s.a AND l.b = s.b WHERE s.a IS NOT NULL GROUP BY ALL""", "pings")
    stages = {"pickup": "IN_REALIZATION", "delivery": "DELIVERED", "return": "RETURNING", "failure": "CRITICAL_FAILURE"}
    seen = ", ".join(
        f"""min("timestamp") FILTER (WHERE status_key = '{s}') AS {n}_timestamp""" for n, s in stages.items())
    q["order_lifecycle"] = with_views(
        f"""SELECT order_id, min("timestamp") AS first_seen, min(preparation_timestamp) AS preparation_timestamp, {seen}
        FROM pings GROUP BY order_id""", "pings")

    fields = """courier_id, first_name, last_name, vehicle_type, vehicle_info, contract_type, active_status, ingested_at,
        source_system, pizzeria_id, accident_risk_factor, fatigue_resistance, vehicle_range_km, vehicle_ownership,
        equipment_set, performance_level"""
    q["csv_scan_typed"] = with_views(f"SELECT CAST(raw_id AS BIGINT) AS raw_id, {fields} FROM couriers", "couriers")
    q["bronze_json_roundtrip"] = with_views(
        f"""WITH {CODED} SELECT event_id, order_id, "timestamp", status_key, lat, lon, speed, zone_key, is_outside_geofence
        FROM coded""", "pings", "couriers")
    month = "strftime(order_date, '%Y-%m')"
    q["partition_scan"] = with_views(
        f"""WITH cleaned AS (SELECT * FROM ({CLEAN_ORDERS}) QUALIFY {month} = max({month}) OVER ()) {KPI}""", "ords")
    q["replace_partition"] = with_views(
        f"""WITH cleaned AS ({CLEAN_ORDERS}), k AS ({KPI})
        SELECT * REPLACE (CASE WHEN {month} = max({month}) OVER () THEN total_revenue * 2 ELSE total_revenue END
          AS total_revenue), {month} AS order_month FROM k""", "ords")
    q["partition_glob"] = with_views(
        f"WITH cleaned AS ({CLEAN_ORDERS}) SELECT {month} AS order_month, count(*) AS orders FROM cleaned GROUP BY ALL", "ords")
    q["compact_partitions"] = with_views(
        f"""WITH cleaned AS ({CLEAN_ORDERS}) SELECT {month} AS order_month, count(*) AS orders,
        CAST(sum(CAST(gross_revenue AS {MONEY})) AS DOUBLE) AS revenue FROM cleaned GROUP BY ALL""", "ords")
    log = """SELECT {ids}, round(gross_revenue, 2) AS gross_revenue, round(delivery_charge, 2) AS delivery_charge,
        pizzeria_lat, pizzeria_lon, order_timestamp, {at} AS ingestion_timestamp FROM ords"""
    q["live_orders_append"] = with_views(
        log.format(ids="order_id, customer_id", at=f"CASE WHEN status = 'F' THEN {NOW} ELSE TIMESTAMP '2024-02-01 00:10:00' END"),
        "ords")
    text_ids = "CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id"
    q["stream_json_ingest"] = with_views(
        f"""SELECT 'order_created' AS event_type, {text_ids}, {ISO.format(t='order_timestamp')} AS order_timestamp,
        gross_revenue, delivery_charge, pizzeria_lat, pizzeria_lon FROM ords""", "ords")
    q["guarded_feeds"] = q["stream_json_ingest"]
    q["silver_orders_stream"] = with_views(
        f"""SELECT 'order_created' AS event_type, {text_ids}, order_timestamp, gross_revenue, delivery_charge,
        pizzeria_lat, pizzeria_lon, order_date, {NOW} AS ingestion_timestamp, {month} AS order_month
        FROM ({CLEAN_ORDERS})""", "ords")
    q["silver_telemetry_stream"] = with_views(
        f"""WITH {CODED} SELECT event_id, courier_id, order_id, "timestamp", CAST("timestamp" AS DATE) AS event_date, lat,
        lon, speed, delivery_timestamp FROM coded WHERE {POSITION}""", "pings", "couriers")
    q["live_fleet_stream"] = with_views(
        f"WITH {CODED} {LATEST_OF_FLEET.format(id='courier_id', event='event_id', source='coded')} "
        + newest.format(k="courier_id"), "pings", "couriers")
    q["live_orders_stream"] = with_views(
        log.format(ids=text_ids, at=NOW) + " WHERE order_timestamp >= TIMESTAMP '1995-06-17 12:00:00' - INTERVAL 24 HOUR", "ords")
    by = 'ORDER BY "timestamp", event_id'
    q["order_perf_asof_stream"] = with_views(
        f"""WITH {CODED}, {HISTORY}, facts AS (SELECT order_id, first(order_timestamp {by}) AS order_timestamp,
            last(courier_id {by}) AS courier_id FROM coded WHERE {POSITION} GROUP BY order_id)
        SELECT f.*, h.vehicle, CAST(h.valid_from AS TIMESTAMP) AS valid_from FROM facts f LEFT JOIN h3 h
          ON h.courier_id = f.courier_id AND f.order_timestamp >= h.valid_from AND (h.valid_to IS NULL OR f.order_timestamp < h.valid_to)""",
        "pings", "couriers")
    q["order_perf_stream"] = with_views(
        f"""WITH {STATUSES}, {CODED}, keyed AS (SELECT p.*, coalesce(p.courier_no + 1000, -1) AS courier_key,
            coalesce(b.base_no + 500, -1) AS pizzeria_key, coalesce(k.customer_id + 1, -1) AS customer_key,
            coalesce(s.status_key, -1) AS status_no, coalesce(p.zone_key, -1) AS zone_no,
            CAST(strftime(p.order_timestamp, '%Y%m%d') AS BIGINT) AS date_key,
            CAST(epoch_us(date_trunc('second', "timestamp")) // 1000000 - epoch_us(order_timestamp) // 1000000 AS DOUBLE)
              AS total_time
          FROM coded p LEFT JOIN bases b ON b.pizzeria_id = 'PIZ-' || split_part(p.courier_id, '-', 2) || '-001'
          LEFT JOIN custs k ON k.customer_id = p.customer_id
          LEFT JOIN statuses s ON s.status_name = p.status_key WHERE p.lat <> 0 AND p.lon <> 0)
        SELECT order_id, first(pizzeria_key {by}) AS pizzeria_key, first(customer_key {by}) AS customer_key,
          first(zone_no {by}) AS zone_key, first(date_key {by}) AS date_key, first(order_timestamp {by}) AS order_timestamp,
          last(courier_key {by}) AS courier_key, last(status_no {by}) AS status_key,
          last(is_outside_geofence {by}) AS outside_geofence,
          last(status_key IN ('DELIVERED', 'RETURNING') {by}) AS is_completed,
          {', '.join(f'last({c} {by}) FILTER (WHERE {c} IS NOT NULL) AS {c}'
                     for c in ('preparation_timestamp', 'pickup_timestamp', 'delivery_timestamp'))},
          max(total_distance) AS total_distance, max(total_time) AS total_time, max("timestamp") AS last_event_at
        FROM keyed GROUP BY order_id
        HAVING first(order_timestamp {by}) >= TIMESTAMP '2024-01-16 00:00:00' - INTERVAL 24 HOUR""", "pings", "couriers", "bases", "custs")
    return q
