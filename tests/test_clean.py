"""Cleaning and typing of hand-made rows with every kind of defect."""

from pyspark.sql import functions as F

from fleetfold import schemas
from fleetfold.operators import clean
from fleetfold.sources import files


def write_lines(path, lines):
    import os

    os.makedirs(f"{path}/dt=2026-01-06", exist_ok=True)
    with open(f"{path}/dt=2026-01-06/part.json", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_only_known_and_non_negative_revenue_is_kept(spark):
    nan, huge = float("nan"), 1e300  # the JSON reader takes NaN for a number
    rows = [("full", 91.25), ("refund", -4.75), ("free", 0.0), ("unknown", None), ("nan", nan), ("huge", huge)]
    df = spark.createDataFrame(rows, "order_id string, gross_revenue double").withColumn(
        "order_timestamp", F.lit("2026-01-06T10:00:00.000001Z")
    )
    kept = {r.order_id: r for r in clean.clean_orders(df).collect()}
    assert set(kept) == {"full", "free"}
    assert str(kept["full"].order_date) == "2026-01-06"
    assert kept["full"].order_timestamp.microsecond == 1


def test_malformed_lines_and_values_become_nulls(spark, path):
    bronze = path("bronze")
    write_lines(
        bronze,
        [
            '{"order_id": "A", "gross_revenue": 10.5, "order_timestamp": "2026-01-06T10:00:00.5Z"}',
            '{"order_id": "B", "gross_revenue": "much", "order_timestamp": "2026-01-06T10:00:00Z"}',
            '{"order_id": "C", "gross_revenue": 1.0, "order_timestamp": "yesterday"}',
            "not json at all",
        ],
    )
    raw = files.read_json(spark, bronze, schemas.ORDER_EVENT)
    assert raw.count() == 4 and "dt" not in raw.columns
    kept = {r.order_id: r for r in clean.clean_orders(raw).collect()}
    assert set(kept) == {"A", "C"}
    assert kept["C"].order_timestamp is None and kept["C"].order_date is None


def test_pings_without_position_are_left_out(spark):
    rows = [("a", 52.0, 21.0), ("b", 0.0, 21.0), ("c", 52.0, 0.0), ("d", None, 21.0), ("e", 52.0, None), ("f", -1.0, -1.0)]
    df = spark.createDataFrame(rows, "event_id string, lat double, lon double").withColumn(
        "timestamp", F.lit("2026-01-06T23:59:59.999999Z")
    )
    kept = clean.clean_telemetry(df).collect()
    assert {r.event_id for r in kept} == {"a", "f"}
    assert {str(r.event_date) for r in kept} == {"2026-01-06"}


def test_order_progress_counts_whole_seconds_and_needs_an_order(spark):
    row = dict.fromkeys(schemas.TELEMETRY_EVENT.names)
    row.update(order_id="O", lat=1.0, lon=1.0, status_key="RETURNING", event_id="1")
    row.update(timestamp="2026-01-06T10:01:00.100000Z", order_timestamp="2026-01-06T10:00:00.900000Z")
    other = {**row, "order_id": None, "event_id": "2"}
    open_ = {**row, "status_key": None, "event_id": "3", "order_id": "P"}
    df = spark.createDataFrame([tuple(r.values()) for r in (row, other, open_)], schemas.TELEMETRY_EVENT)
    got = {r.order_id: r for r in clean.order_perf_project(df).collect()}
    assert set(got) == {"O", "P"}
    assert got["O"].total_time == 60.0 and got["O"].is_completed is True
    assert got["P"].is_completed is False


def test_fleet_projection_casts_and_needs_a_courier(spark):
    row = dict.fromkeys(schemas.TELEMETRY_EVENT.names)
    row.update(courier_id="C", lat=52.123456, lon=21.0, speed=35.55, timestamp="2026-01-06T10:00:00Z")
    df = spark.createDataFrame([tuple(row.values()), tuple({**row, "courier_id": None}.values())], schemas.TELEMETRY_EVENT)
    got = clean.live_fleet_project(df).collect()
    assert len(got) == 1 and str(got[0].current_lat) == "52.1235" and str(got[0].speed_kmh) == "35.55"


def test_enforce_types_skips_absent_columns_and_can_be_safe(spark):
    df = spark.createDataFrame([("7", "x")], "a string, b string")
    typed = clean.enforce_types(df, {"a": "int", "b": "int", "c": "date"}, safe=True)
    assert typed.dtypes == [("a", "int"), ("b", "int")]
    assert tuple(typed.first()) == (7, None)


def test_typed_csv(spark, path):
    import os

    folder = path("csv")
    os.makedirs(folder)
    header = ",".join(schemas.CUSTOMER_FILE.names)
    with open(f"{folder}/c.csv", "w") as f:
        f.write(header + "\n1,C-1,Ann,a@example.com,Street 1,52.2,21.0,VIP,2026-01-06 10:15:00,App\n")
        f.write("x,C-2,Bob,b@example.com,Street 2,north,21.0,VIP,2026-01-06 10:15:00,App\n")
    rows = {r.customer_id: r for r in files.read_csv(spark, folder, schemas.CUSTOMER_FILE).collect()}
    assert rows["C-1"].lat == 52.2 and rows["C-1"].raw_id == 1
    assert rows["C-2"].lat is None and rows["C-2"].raw_id is None
