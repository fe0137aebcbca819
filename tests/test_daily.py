"""The whole daily run over files of the declared formats."""

import os

import pytest
from test_streams import Feed, order, ping

from fleetfold import schemas
from fleetfold.operators import dims, star
from fleetfold.plans import daily
from fleetfold.sources.tables import VersionedTable

COURIER = {
    "raw_id": "1", "courier_id": "C-WAW-01", "first_name": "Ann", "last_name": "Lee", "vehicle_type": "bike",
    "vehicle_info": "Road", "contract_type": "B2B", "active_status": "active", "ingested_at": "2026-01-06 10:00:00",
    "source_system": "HR", "pizzeria_id": "PIZ-WAW-001", "accident_risk_factor": "0.02", "fatigue_resistance": "0.90",
    "vehicle_range_km": "40.0", "vehicle_ownership": "Private", "equipment_set": "Standard", "performance_level": "High",
}
CUSTOMER = {
    "raw_id": "0", "customer_id": "K1", "full_name": "Bob Ray", "email": "b@example.com", "address_raw": "Street 1",
    "lat": "52.23", "lon": "21.01", "segment_tag": "VIP", "ingested_at": "2026-01-06 10:00:00", "source_system": "App",
}
BASE = {
    "raw_id": "1", "pizzeria_id": "PIZ-WAW-001", "pizzeria_name": "Central", "city": "Warsaw", "address_raw": "Street 2",
    "lat": "52.2297", "lon": "21.0122", "manager_info": "Eve", "ingested_at": "2026-01-06 10:00:00",
}


def write_csv(folder, schema, *rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/data.csv", "w") as f:
        f.write(",".join(schema.names) + "\n")
        f.writelines(",".join(r[n] for n in schema.names) + "\n" for r in rows)


def test_daily_run_twice(spark, path):
    lake = path("lake")
    write_csv(f"{lake}/bronze/couriers", schemas.COURIER_FILE, COURIER, {**COURIER, "courier_id": "C-WAW-02"})
    write_csv(f"{lake}/bronze/customers", schemas.CUSTOMER_FILE, CUSTOMER)
    write_csv(f"{lake}/bronze/pizzerias", schemas.PIZZERIA_FILE, BASE)
    orders = Feed(f"{lake}/bronze/orders", schemas.ORDER_EVENT).add(order("a"), order("b", 5, -3.0)).add(order("c", 9, 70.0))
    Feed(f"{lake}/bronze/telemetry", schemas.TELEMETRY_EVENT).add(ping("C-WAW-01", "a", 4, "PREPARING"))
    daily.run_daily(spark, lake, "2026-01-06", "2026-01-07 00:00:00")

    figures = spark.read.parquet(f"{lake}/gold/daily_sales_fact").collect()
    assert [(str(r.order_date), str(r.total_revenue), r.total_orders) for r in figures] == [("2026-01-06", "120.00", 2)]
    for name, rows in {"dim_courier": 3, "dim_pizzeria": 2, "dim_customer": 2, "dim_delivery_zone": 6, "dim_order_status": 8, "dim_date": 1096}.items():
        assert VersionedTable(spark, f"{lake}/gold/{name}").read().count() == rows, name
    assert spark.read.parquet(f"{lake}/silver/telemetry_compacted/data").count() == 1

    # The next run: a courier changes vehicle, another order arrives; the day's figures are replaced.
    write_csv(f"{lake}/bronze/couriers", schemas.COURIER_FILE, {**COURIER, "vehicle_type": "car"}, {**COURIER, "courier_id": "C-WAW-02"})
    orders.add(order("d", 11, 30.0))
    daily.run_daily(spark, lake, "2026-01-06", "2026-01-08 00:00:00")
    figures = spark.read.parquet(f"{lake}/gold/daily_sales_fact").collect()
    assert [(str(r.total_revenue), r.total_orders) for r in figures] == [("150.00", 3)]
    couriers = VersionedTable(spark, f"{lake}/gold/dim_courier").read().where("courier_key > 0").collect()
    assert sorted((r.courier_id, r.vehicle, r.is_current, r.courier_key) for r in couriers) == [
        ("C-WAW-01", "bike - Road", False, 1),
        ("C-WAW-01", "car - Road", True, 3),
        ("C-WAW-02", "bike - Road", True, 2),
    ]
    assert daily.silver_table(spark, lake, "orders").read().count() == 3


def test_one_failing_dimension_does_not_hide(spark, path):
    gold = path("gold")
    staged = {"dim_courier": spark.range(1), "dim_delivery_zone": dims.delivery_zones(spark)}
    with pytest.raises(RuntimeError, match="dim_courier"):
        daily.load_gold_dimensions(spark, gold, staged)
    assert VersionedTable(spark, f"{gold}/dim_delivery_zone").read().count() == 6


def test_jobs_by_name_and_reports_in_sql(spark, path):
    from fleetfold.__main__ import main
    from fleetfold.plans.warehouse import register_gold

    lake = path("lake")
    write_csv(f"{lake}/bronze/couriers", schemas.COURIER_FILE, COURIER)
    write_csv(f"{lake}/bronze/customers", schemas.CUSTOMER_FILE, CUSTOMER)
    write_csv(f"{lake}/bronze/pizzerias", schemas.PIZZERIA_FILE, BASE)
    Feed(f"{lake}/bronze/orders", schemas.ORDER_EVENT).add(order("a"), order("b", 5))
    telemetry = Feed(f"{lake}/bronze/telemetry", schemas.TELEMETRY_EVENT).add(ping("C-WAW-01", "a", 4, "PREPARING"))
    telemetry.add(ping("C-WAW-01", "a", 130, "DELIVERED"), ping("nobody", "b", 7, "AT_CUSTOMER"))
    for job in ("gold-dimensions", "silver-orders", "silver-telemetry"):
        main([job, "--lake", lake], spark)
    for job in ("live-fleet", "live-orders", "order-performance"):
        main([job, "--lake", lake, "--once"], spark)
    main(["daily-kpi", "--lake", lake, "--process-date", "2026-01-06"], spark)
    main(["daily-kpi", "--lake", lake, "--process-date", "1999-01-01"], spark)  # no orders: no change
    main(["compact", "--lake", lake], spark)
    with pytest.raises(SystemExit):
        main(["daily", "--lake", lake], spark)

    names = register_gold(spark, f"{lake}/gold", "2026-01-06 11:00:00")
    assert {"v_order_360", "daily_sales_fact", "live_fleet_status", "dim_date"} <= set(names)
    rows = spark.sql("SELECT * FROM v_order_360 ORDER BY order_id").collect()
    a, b = rows
    assert (a.courier_name, a.pizzeria_name, a.customer_name, a.zone_name) == ("Ann Lee", "Central", "Bob Ray", "Zone 2")
    assert (a.raw_status, a.simple_order_status, a.realization_percent, a.delayed_delivery) == ("DELIVERED", "COMPLETED", 100.0, True)
    assert str(a.gross_revenue) == "50.00" and a.average_speed_kmh == 360.0
    assert (b.courier_name, b.raw_status, b.realization_percent) == (None, "AT_CUSTOMER", 99.0)
    assert spark.sql("SELECT total_orders FROM daily_sales_fact").collect()[0][0] == 2
    # Every key of a fact has its member, the unknown one included.
    for dim, key in (("dim_courier", "courier_key"), ("dim_order_status", "status_key"), ("dim_delivery_zone", "zone_key")):
        assert star.orphans(spark.table("fact_order_performance"), spark.table(dim), key, key).count() == 0
    assert sorted(r.courier_key for r in spark.table("dim_courier").collect()) == [-1, 1]
