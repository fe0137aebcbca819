"""Trips, life cycles, lateness and copies on small hand-made feeds."""

import random

from pyspark.sql import functions as F

from fleetfold.operators import dims, kpi, star, telemetry


def trip(spark):
    """One full life cycle: waiting, cooking, riding out, serving, riding back, waiting."""
    start, rows, t = 1_767_693_600, [], 0
    home, door = (52.229676, 21.012229), (52.2425, 21.035)

    def ping(status, pos, order="O1"):
        nonlocal t
        rows.append(("C-FAST-01", order, f"e{t:03d}", start + t, status, float(pos[0]), float(pos[1])))
        t += 1

    for _ in range(3):
        ping("IDLE", home, None)
    for _ in range(10):
        ping("PREPARING", home)
    steps = 20
    for i in range(steps + 1):
        ping("IN_REALIZATION", [h + (d - h) * i / steps for h, d in zip(home, door)])
    for _ in range(15):
        ping("AT_CUSTOMER", door)
    ping("DELIVERED", door)
    for i in range(steps + 1):
        ping("RETURNING", [d + (h - d) * i / steps for h, d in zip(home, door)])
    for _ in range(3):
        ping("IDLE", home, None)
    schema = "courier_id string, order_id string, event_id string, at long, status string, lat double, lon double"
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("ts", F.timestamp_seconds("at")).drop("at").repartition(4), home, door


def test_life_cycle_of_a_trip_is_regular(spark):
    df, *_ = trip(spark)
    counts = telemetry.status_transitions(df, "status", "ts").collect()
    assert all(r.allowed for r in counts)
    found = {(r.from_status, r.to_status): r.transitions for r in counts}
    assert found[("PREPARING", "PREPARING")] == 9 and found[("IDLE", "IDLE")] == 4
    assert found[("DELIVERED", "RETURNING")] == found[("RETURNING", "IDLE")] == 1
    cut = telemetry.status_transitions(df, "status", "ts", max_group_rows=0).collect()
    assert {(r.from_status, r.to_status): r.transitions for r in cut} == found


def test_irregular_transitions_are_marked(spark):
    rows = [("c", "1", "RETURNING", 1), ("c", "2", "CRITICAL_FAILURE", 2), ("c", "3", "PREPARING", 3), ("c", "4", "CRITICAL_FAILURE", 4)]
    df = spark.createDataFrame(rows, "courier_id string, event_id string, status string, ts int")
    got = {(r.from_status, r.to_status): r.allowed for r in telemetry.status_transitions(df, "status", "ts").collect()}
    assert got == {
        ("RETURNING", "CRITICAL_FAILURE"): False,
        ("CRITICAL_FAILURE", "PREPARING"): False,
        ("PREPARING", "CRITICAL_FAILURE"): True,
    }


def test_odometer_counts_out_and_back(spark):
    import test_spatial

    df, home, door = trip(spark)
    there = test_spatial.km(home, door)
    for limit in (0, 1000):
        totals = {r.order_id: r for r in telemetry.trip_totals(df, "ts", max_group_rows=limit).collect()}
        assert abs(float(totals["O1"].trip_km) - 2 * there) < 1e-3 and totals["O1"].pings == 68
        assert float(totals[None].trip_km) == 0.0
        metered = telemetry.trip_odometer(df, "ts", status="status", max_group_rows=limit)
        last = metered.where("order_id = 'O1'").agg(F.max("odometer_km"), F.sum("hop_km")).first()
        assert last[0] == last[1] and abs(float(last[0]) - 2 * there) < 1e-3


def test_stage_times_of_an_order(spark):
    df, *_ = trip(spark)
    stages = {r.order_id: r for r in telemetry.order_lifecycle(df, "status", "ts").collect()}
    assert set(stages) == {"O1"}
    row, at = stages["O1"], {s: df.where(f"status = '{s}'").agg(F.min("ts")).first()[0] for s in ("IN_REALIZATION", "DELIVERED", "RETURNING")}
    assert (row.pickup_timestamp, row.delivery_timestamp, row.return_timestamp) == tuple(at.values())
    assert row.failure_timestamp is None


def test_resampling_lies_on_the_leg(spark):
    rows = [("c", "o", 1, 0, 0.0, 0.0), ("c", "o", 2, 10, 10.0, 20.0), ("c", "o", 3, 11, 10.5, 20.0)]
    df = spark.createDataFrame(rows, "courier_id string, order_id string, id int, s int, lat double, lon double")
    df = df.withColumn("ts", F.timestamp_seconds("s")).drop("s")
    got = {int(r.at.timestamp()): (round(r.lat, 6), round(r.lon, 6)) for r in telemetry.resample(df, "ts", "id", 4).collect()}
    assert got == {0: (0.0, 0.0), 4: (4.0, 8.0), 8: (8.0, 16.0)}


def test_gap_rule_looks_at_the_previous_event(spark):
    minutes = [0, 9, 18, 28, 28, 39]
    df = spark.createDataFrame([("a", i, m * 60) for i, m in enumerate(minutes)] + [("b", 9, 0)], "k string, id int, s long")
    df = df.withColumn("ts", F.timestamp_seconds("s")).drop("s")
    for limit in (0, 1000):
        kept = {r.id for r in telemetry.dedup_window(df, "k", "ts", "id", max_group_rows=limit).collect()}
        assert kept == {0, 3, 5, 9}


def test_late_rule_uses_batches_up_to_the_last_but_one(spark):
    rows = [(1, 100, 1), (2, 200, 2), (3, 89, 3), (3, 90, 4), (3, 91, 5), (4, 190, 6), (4, 191, 7), (4, None, 8)]
    df = spark.createDataFrame(rows, "batch int, m long, id int").withColumn("ts", F.timestamp_seconds(F.col("m") * 60)).drop("m")
    for limit in (0, 1000):
        got = {r.id: r.is_late for r in telemetry.late_data_split(df, "batch", "ts", 10, limit).collect()}
        assert got == {1: False, 2: False, 3: True, 4: True, 5: False, 6: True, 7: False, 8: False}


def test_calendar(spark):
    days = dims.date_attributes(dims.date_range(spark))
    assert days.count() == 1095
    row = {r.date_key: r for r in days.collect()}
    assert row[20250101].day_name == "Wednesday" and row[20250101].day_of_week == 4 and row[20250101].season == "Winter"
    assert row[20250104].is_weekend and row[20250105].is_weekend and not row[20250106].is_weekend
    assert row[20271231].quarter == "Q4" and row[20270815].month_name == "August"
    holidays = spark.createDataFrame([("2025-05-03",), ("2025-05-03",)], "d string").select(F.to_date("d").alias("full_date"))
    marked = dims.date_attributes(dims.date_range(spark), holidays)
    assert marked.count() == 1095 and [r.date_key for r in marked.where("is_holiday").collect()] == [20250503]


def test_point_in_time_lookup_is_half_open(spark):
    versions = spark.createDataFrame(
        [("a", "bike", 0, 10), ("a", "car", 10, None), ("c", "gone", 0, 5), (None, "none", 0, None)], "k string, v string, f long, t long"
    ).select("k", "v", F.timestamp_seconds("f").alias("valid_from"), F.timestamp_seconds("t").alias("valid_to"))
    facts = spark.createDataFrame([("a", 0), ("a", 9), ("a", 10), ("a", 99), ("a", -1), ("b", 5), ("c", 4), ("c", 5), (None, 3)], "k string, s long")
    facts = facts.withColumn("at", F.timestamp_seconds("s"))
    ways = [{}, {"max_versions": 0}, {"max_versions": 0, "max_group_rows": 0}]
    results = [{(r.k, r.s): r.v for r in star.as_of_join(facts, versions, "k", "at", ["v"], **w).collect()} for w in ways]
    got = results[0]
    assert results[1] == got and results[2] == got
    assert got == {("a", 0): "bike", ("a", 9): "bike", ("a", 10): "car", ("a", 99): "car", ("a", -1): None,
                   ("b", 5): None, ("c", 4): "gone", ("c", 5): None, (None, 3): None}


def test_exact_percentile_of_lag(spark):
    df = spark.range(1, 101).select(F.lit(1).alias("g"), F.timestamp_seconds(F.lit(0)).alias("ts"), (F.col("id") * 1_000_000).alias("a"))
    row = kpi.ingestion_lag(df, F.col("g"), "ts", F.col("a")).first()
    assert (row.events, row.avg_lag_sec, row.max_lag_sec, row.p95_lag_sec) == (100, 50.5, 100, 95)


def test_daily_figures_are_exact_decimals(spark):
    rows = [("a", 0.1, 8.0), ("b", 0.2, None), ("c", 0.3, 8.5), (None, 0.4, 1.0)]
    df = spark.createDataFrame(rows, "order_id string, gross_revenue double, delivery_charge double")
    df = df.withColumn("order_date", F.lit("2026-01-06").cast("date"))
    row = kpi.daily_kpi(df, "2026-01-07 00:00:00").first()
    assert (str(row.total_revenue), str(row.total_delivery_fees), row.total_orders, str(row.avg_order_value)) == ("1.00", "17.50", 3, "0.25")


def test_constraint_checks(spark):
    facts = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "z")], "id int, k string")
    dim = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert [tuple(r) for r in star.duplicate_keys(facts, ["id"]).collect()] == [(1, 2)]
    assert [r.id for r in star.orphans(facts, dim, "k", "k").collect()] == [3]


def test_point_in_time_lookup_meets_one_of_overlapping_versions(spark):
    rows = [("a", "old", 0, 20), ("a", "new", 10, None), ("b", "x", 0, 10), ("b", "y", 10, 20), ("c", "p", 0, 5), ("c", "q", 0, None), ("d", "r", 5, 8), ("d", "s", 0, 99)]
    versions = spark.createDataFrame(rows, "k string, v string, f long, t long").select(
        "k", "v", F.timestamp_seconds("f").alias("valid_from"), F.timestamp_seconds("t").alias("valid_to")
    )
    facts = spark.createDataFrame([(k, s) for k in "abcd" for s in (0, 4, 9, 10, 15, 20, 30)] * 2, "k string, s long")
    facts = facts.withColumn("at", F.timestamp_seconds("s"))
    ways = [{}, {"max_versions": 0}, {"max_versions": 0, "max_group_rows": 0}]
    results = [sorted((r.k, r.s, r.v or "") for r in star.as_of_join(facts, versions, "k", "at", ["v"], **w).collect()) for w in ways]
    assert len(results[0]) == 56 and results[0] == results[1] == results[2]
    got = {(k, s): v for k, s, v in results[0]}
    assert [got["a", s] for s in (9, 10, 15, 30)] == ["old", "new", "new", "new"]
    assert [got["b", s] for s in (9, 10, 20)] == ["x", "y", ""] and got["c", 4] == "q"
    assert [got["d", s] for s in (4, 9)] == ["s", ""]  # r began last, so it decides


def test_odometer_cuts_its_rows_once(spark, monkeypatch):
    from fleetfold.plans import ordered

    pinned = []
    real = ordered.pin
    monkeypatch.setattr(ordered, "pin", lambda df, name: pinned.append(name) or real(df, name))
    pings = spark.range(300).select(
        (F.col("id") % 3).alias("courier_id"), F.lit("o").alias("order_id"), "id", F.timestamp_seconds("id").alias("ts"),
        (F.col("id") / 100).alias("lat"), F.lit(21.0).alias("lon"),
    ).withColumnRenamed("id", "event_id")
    cut = telemetry.trip_odometer(pings, "ts", max_group_rows=0)
    assert pinned == ["ranges"]
    plain = telemetry.trip_odometer(pings, "ts")
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, plain.collect()))


def test_odometer_segments_in_any_split_give_the_batch_totals(spark):
    """Late pings inside stored segments, repeats, segments apart, and a trip over several spans."""
    rng = random.Random(9)
    rows = [(c, o, float(rng.randrange(0, 20_000)), f"e{c}{o}{k}", 52 + rng.random() / 10, 21 + rng.random() / 10) for c in "AB" for o in ("x", None) for k in range(30)]
    rows.append((None, "x", 5.0, "none", 52.0, 21.0))
    schema = "courier_id string, order_id string, s double, event_id string, lat double, lon double"
    pings = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("s"))
    expected = {(r.courier_id, r.order_id): (r.pings, r.trip_km) for r in telemetry.trip_totals(pings.where("courier_id is not null"), "ts").collect()}
    for split in (1, 4):
        states = None
        for part in [*range(split), 0]:  # the first part twice
            some = pings.where(F.pmod(F.xxhash64("event_id"), F.lit(split)) == part)
            state = telemetry.track_segments(some, "ts")
            states = state if states is None else telemetry.merge_segments(states.unionByName(state))
        got = {(r.courier_id, r.order_id): (r.pings, r.trip_km) for r in telemetry.segment_totals(states).collect()}
        assert got == expected


def test_lag_folds_equal_the_exact_figures_and_stay_near_beyond(spark):
    from fleetfold.operators import kpi

    events = spark.range(20_000).select((F.col("id") % 2).alias("g"), F.timestamp_seconds(F.lit(0)).alias("ts"), (F.pow(F.col("id") % 997, F.lit(2)) * 1000).cast("long").alias("arrival"))
    few = events.limit(700)
    exact = lambda df: {r.g: r for r in kpi.ingestion_lag(df, F.col("g"), "ts", F.col("arrival")).collect()}
    for df, near in ((few, 0), (events, 0.02)):
        parts = [kpi.lag_state(df.where(F.pmod("arrival", F.lit(3)) == k), F.col("g"), "ts", F.col("arrival")) for k in range(3)]
        got = {r.g: r for r in kpi.read_lags(kpi.merge_lags(parts[0].unionByName(parts[1]).unionByName(parts[2]))).collect()}
        for g, row in exact(df).items():
            assert (got[g].events, got[g].avg_lag_sec, got[g].max_lag_sec) == (row.events, row.avg_lag_sec, row.max_lag_sec)
            assert abs(got[g].p95_lag_sec - row.p95_lag_sec) <= near * row.max_lag_sec
