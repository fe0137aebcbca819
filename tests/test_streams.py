"""Streams: several micro-batches, restarts, failures, and equality with the batch twins."""

import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fleetfold import schemas
from fleetfold.operators import dims, merge, telemetry
from fleetfold.sources import files
from fleetfold.sources.tables import BatchTable, VersionedTable
from fleetfold.streaming import ingest, live


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


class Feed:
    """JSON files in the order given, one per micro-batch."""

    def __init__(self, path, schema):
        self.path, self.schema, self.n = path, schema, 0

    def add(self, *events):
        folder = f"{self.path}/dt=2026-01-06"
        os.makedirs(folder, exist_ok=True)
        name = f"{folder}/f{self.n:04d}.json"
        with open(name + ".tmp", "w") as f:
            f.write("".join((e if isinstance(e, str) else json.dumps(e)) + "\n" for e in events))
        os.utime(name + ".tmp", (1_700_000_000 + self.n, 1_700_000_000 + self.n))
        os.rename(name + ".tmp", name)
        self.n += 1
        return self

    def stream(self, spark, **kw):
        return files.stream_json(spark, self.path, self.schema, max_files=1, **kw)


def at(seconds):
    return f"2026-01-06T10:{seconds // 60:02d}:{seconds % 60:02d}.000000Z"


def ping(courier, order, second, status, **kw):
    return dict(
        event_type="telemetry", event_id=f"{courier}{order}{second:05d}", courier_id=courier, order_id=order,
        timestamp=at(second), status_key=status, lat=52.2, lon=21.0, speed=10.0, customer_id="K1", zone_key=2,
        order_timestamp=at(0), is_outside_geofence=False, total_distance=second / 10, **kw,
    )


def order(name, second=0, revenue=50.0):
    return dict(event_type="order_created", order_id=name, customer_id="K1", order_timestamp=at(second), gross_revenue=revenue, delivery_charge=8.004)


def test_drain_resumes_where_it_stopped(spark, path):
    feed = Feed(path("bronze"), schemas.ORDER_EVENT).add(order("a"), order("b", revenue=-1.0), "{broken")
    out, checkpoint, archive = path("silver"), path("cp"), path("archive")
    for _ in range(2):
        ingest.silver_orders(spark, feed.path, out, checkpoint, 1, archive).awaitTermination()
    assert [r.order_id for r in spark.read.parquet(out).collect()] == ["a"]
    feed.add(order("c")).add(order("d"))
    ingest.silver_orders(spark, feed.path, out, checkpoint, 1, archive).awaitTermination()
    silver = spark.read.parquet(out)
    assert sorted(r.order_id for r in silver.collect()) == ["a", "c", "d"]
    assert "dt" not in silver.columns and silver.schema["order_date"].dataType.typeName() == "date"


def test_fleet_keeps_the_newest_ping_over_batches_and_restarts(spark, path):
    feed = Feed(path("bronze"), schemas.TELEMETRY_EVENT)
    feed.add(ping("A", "o", 5, "PREPARING"), ping("A", "o", 1, "IDLE"), ping("B", "p", 1, "IDLE"))
    feed.add(ping("A", "o", 3, "IDLE")).add(ping(None, "x", 9, "IDLE")).add(ping("B", "p", 7, "RETURNING"))
    table, checkpoint = live.fleet_table(spark, path("fleet")), path("cp")
    live.live_fleet(feed.stream(spark), table, checkpoint, every=None, fold_every=2).awaitTermination()
    state = {r.courier_id: (r.order_status, r.updated_at.second) for r in table.read().collect()}
    assert state == {"A": ("PREPARING", 5), "B": ("RETURNING", 7)}
    feed.add(ping("A", "o", 8, "IN_REALIZATION")).add(ping("A", "o", 6, "PREPARING"))
    live.live_fleet(feed.stream(spark), table, checkpoint, every=None, fold_every=2).awaitTermination()
    state = {r.courier_id: (r.order_status, r.updated_at.second) for r in table.read().collect()}
    assert state == {"A": ("IN_REALIZATION", 8), "B": ("RETURNING", 7)}


def test_orders_log_takes_each_order_once_and_forgets_old_ones(spark, path):
    feed = Feed(path("bronze"), schemas.ORDER_EVENT)
    feed.add(order("a"), order("a"), order(None)).add(order("a", 9), order("b", 5)).add(order("c", 60))
    table = live.orders_table(spark, path("log"))
    live.live_orders(
        feed.stream(spark), table, path("cp"), every=None, as_of="2026-01-07 10:00:04", fold_every=2
    ).awaitTermination()
    # Order a, at 10:00:00, is older than a day by then; its date folder is not, and stays.
    kept = live.read_orders(table, "2026-01-07 10:00:04")
    assert sorted((r.order_id, r.delivery_charge) for r in kept.collect()) == [("b", 8.0), ("c", 8.0)]
    assert sorted(r.order_id for r in table.read().collect()) == ["a", "b", "c"]
    live.forget(table, "2026-01-08 10:00:04", 24)
    assert table.read().count() == 0


def dimensions(spark):
    couriers = spark.createDataFrame([("C-WAW-01", 7, True), ("C-WAW-01", 3, False)], "courier_id string, courier_key long, is_current boolean")
    places = spark.createDataFrame([("PIZ-WAW-001", 4, True)], "pizzeria_id string, pizzeria_key long, is_current boolean")
    customers = spark.createDataFrame([("K1", 11)], "customer_id string, customer_key long")
    return live.Dimensions(couriers, customers, dims.order_statuses(spark), places)


def test_order_facts_merge_column_by_column(spark, path):
    c = "C-WAW-01"
    feed = Feed(path("bronze"), schemas.TELEMETRY_EVENT)
    feed.add(ping(c, "o", 30, "IN_REALIZATION", pickup_timestamp=at(30)), ping(c, "o", 10, "PREPARING"))
    feed.add(ping(c, "o", 90, "DELIVERED", delivery_timestamp=at(90)))
    feed.add(ping(c, "o", 60, "AT_CUSTOMER"), ping("stranger", "p", 5, "LOST"), ping(c, None, 5, "IDLE"))
    table = live.performance_table(spark, path("facts"))
    live.order_performance(
        feed.stream(spark), table, dimensions(spark), path("cp"), every=None, fold_every=2, keep_hours=None
    ).awaitTermination()
    got = {r.order_id: r for r in live.read_performance(table).collect()}
    assert set(got) == {"o", "p"}
    o = got["o"]
    assert (o.courier_key, o.pizzeria_key, o.customer_key, o.status_key, o.zone_key, o.date_key) == (7, 4, 11, 5, 2, 20260106)
    assert (o.total_time, o.total_distance, o.is_completed) == (90.0, 9.0, True)
    assert o.pickup_timestamp.second == 30 and o.delivery_timestamp.second == 30 and o.return_timestamp is None
    assert (got["p"].courier_key, got["p"].pizzeria_key, got["p"].status_key) == (-1, -1, -1)


def moving(spark, gold):
    """Versioned dimensions, and a load of couriers by day."""
    for name, df in {
        "dim_pizzeria": spark.createDataFrame([("PIZ-WAW-001", 4)], "pizzeria_id string, pizzeria_key long"),
        "dim_customer": spark.createDataFrame([("K1", 11)], "customer_id string, customer_key long"),
        "dim_order_status": dims.order_statuses(spark),
    }.items():
        VersionedTable(spark, f"{gold}/{name}").write(df)
    table = VersionedTable(spark, f"{gold}/dim_courier", keep=1)
    schema = "courier_id string, vehicle string, valid_from timestamp, valid_to timestamp, is_current boolean, courier_key long, seen_at array<timestamp>"

    def load(day, **vehicles):
        target = table.read()
        target = spark.createDataFrame([], schema) if target is None else target
        staged = spark.createDataFrame([(c.replace("_", "-"), v) for c, v in vehicles.items()], "courier_id string, vehicle string")
        table.write(merge.scd2_merge(target, staged, "courier_id", ["vehicle"], day, "courier_key"))

    return table, load


def test_a_stream_sees_the_loads_that_end_while_it_runs(spark, path):
    """Five loads, one before each batch, each dropping the version before; a courier is hired after the start."""
    gold = path("gold")
    table, load = moving(spark, gold)
    feed = Feed(path("bronze"), schemas.TELEMETRY_EVENT)
    load("2026-01-01", C_WAW_01="bike")
    dims_now = live.GoldDimensions(spark, gold)
    dims_now.tables["courier"] = table
    facts, metrics, checkpoint = live.performance_table(spark, path("facts")), live.metrics_table(spark, path("metrics")), path("cp")
    for n in range(5):
        feed.add(ping("C-WAW-01", f"o{n}", n, "PREPARING"), ping("C-WAW-02", f"p{n}", n, "PREPARING"))
        if n == 2:
            load("2026-01-03", C_WAW_02="car")
        elif n:
            load(f"2026-01-0{n + 1}", C_WAW_01=f"bike {n}")
        live.order_performance(
            feed.stream(spark), facts, dims_now, checkpoint, every=None, keep_hours=None, metrics=metrics
        ).awaitTermination()
    keys = {r.order_id: r.courier_key for r in live.read_performance(facts).collect()}
    assert keys["p0"] == keys["p1"] == -1 and keys["p2"] == keys["p4"] > 0
    assert keys["o0"] == 1 and len({keys["o0"], keys["o1"], keys["o3"], keys["o4"]}) == 4
    assert sorted((r.batch, r.rows_read, r.rows_written) for r in metrics.read().collect()) == [(n, 2, 2) for n in range(5)]
    assert list(table.versions()) == [5] and not table.leased()


def test_a_load_under_a_running_batch_does_not_drop_what_it_reads(spark, path):
    gold = path("gold")
    table, load = moving(spark, gold)
    load("2026-01-01", C_WAW_01="bike")
    dims_now = live.GoldDimensions(spark, gold)
    dims_now.tables["courier"] = table
    with dims_now.snapshot() as held:
        for n in range(2, 5):
            load(f"2026-01-0{n}", C_WAW_01=f"bike {n}")
        assert [r.vehicle for r in held.courier.collect()] == ["bike"]
    with dims_now.snapshot() as held:
        assert held.courier.count() == 4
    with pytest.raises(LookupError):
        with live.GoldDimensions(spark, path("none")).snapshot():
            pass


def test_a_late_version_changes_the_facts_in_its_span(spark, path):
    gold = path("gold")
    table, load = moving(spark, gold)
    load("2026-01-01", C_WAW_01="bike", C_WAW_02="car")
    load("2026-01-06 10:01:00", C_WAW_01="van")
    feed = Feed(path("bronze"), schemas.TELEMETRY_EVENT)
    rows = [dict(ping(c, f"{c[-1]}{s}", s, "PREPARING"), order_timestamp=at(s)) for s in (10, 30, 50, 70) for c in ("C-WAW-01", "C-WAW-02")]
    feed.add(*rows[:4]).add(*rows[4:])
    policies = live.AS_OF_PERFORMANCE
    facts = live.performance_table(spark, path("facts"), policies)
    live.order_performance(
        feed.stream(spark), facts, live.GoldDimensions(spark, gold), path("cp"), every=None, policies=policies, keep_hours=None,
        courier_at="order_timestamp",
    ).awaitTermination()
    held = live.read_performance(facts, policies)
    keys = {r.order_id: r.courier_key for r in held.collect()}
    assert keys["110"] == keys["130"] == keys["150"] != keys["170"] and len({keys[f"2{s}0"] for s in (1, 3, 5, 7)}) == 1
    assert live.restated_couriers(held, table.read()).count() == 0
    load("2026-01-06 10:00:30", C_WAW_01="scooter", C_WAW_02="car")
    changed = {r.order_id: r.courier_key for r in live.restated_couriers(held, table.read()).collect()}
    assert set(changed) == {"130", "150"} and len(set(changed.values())) == 1
    only = spark.createDataFrame([("C-WAW-02",)], "courier_id string")
    assert live.restated_couriers(held, table.read(), changed=only).count() == 0


def test_a_batch_opens_only_the_buckets_of_its_keys(spark, path):
    """What a batch reads of the state stays the same while other keys and days fill it."""
    last = live.LastSeen(spark, path("last"), "k", "ts", "id", buckets=64)
    events = spark.range(2000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.timestamp_seconds(F.col("id") * 600).alias("ts"), F.col("id").cast("string").alias("id"))
    one = spark.createDataFrame([("k7", "1")], "k string, id string").withColumn("ts", F.timestamp_seconds(F.lit(7 * 600 + 60)))
    opened, read = [], last.table._read

    def counting(paths, where=None):
        rows = read(paths, where)
        opened.append(rows.select(F.input_file_name()).distinct().count())
        return rows

    last.table._read = counting
    for n, (a, b) in enumerate([(0, 100), (100, 500), (500, 2000)]):
        last.table.put(events.where(F.col("id").cast("int").between(a, b - 1)), n)
        before = last.before(one, n + 1)
        assert [r.k for r in before.collect()] == ["k7"]
        last.table.fold(n)
    assert opened[0] <= 2 and opened[::2] == [opened[0]] * 3  # every other read is that of the fold


def test_a_failing_batch_stops_the_query_and_is_taken_again(spark, path):
    feed = Feed(path("bronze"), schemas.TELEMETRY_EVENT).add(ping("A", "o", 1, "IDLE")).add(ping("B", "o", 2, "IDLE"))
    checkpoint = path("cp")

    class Failing(BatchTable):
        def put(self, rows, batch_id):
            if batch_id == 1:
                raise ValueError("disk full")
            super().put(rows, batch_id)

    good = live.fleet_table(spark, path("fleet"))
    with pytest.raises(StreamingQueryException):
        live.live_fleet(feed.stream(spark), Failing(spark, good.root, good.combine), checkpoint, every=None).awaitTermination()
    assert {r.courier_id for r in good.read().collect()} == {"A"}
    live.live_fleet(feed.stream(spark), good, checkpoint, every=None).awaitTermination()
    assert {r.courier_id for r in good.read().collect()} == {"A", "B"}


def test_periodic_trigger(spark, path):
    feed = Feed(path("bronze"), schemas.TELEMETRY_EVENT).add(ping("A", "o", 1, "IDLE"))
    table = live.fleet_table(spark, path("fleet"))
    query = live.live_fleet(feed.stream(spark), table, path("cp"), every="1 second")
    query.processAllAvailable()
    feed.add(ping("A", "o", 2, "PREPARING"))
    query.processAllAvailable()
    query.stop()
    assert [r.order_status for r in table.read().collect()] == ["PREPARING"]


def test_late_twin_drops_what_the_watermark_drops(spark, path):
    """With one file per micro-batch, Spark's own late filter and the batch rule agree."""
    minutes = [[0, 5], [30, 2], [21, 19, 40], [12, 29, 31, 60], [49, 50, 51, 20]]
    feed, rows = Feed(path("bronze"), schemas.TELEMETRY_EVENT), []
    for batch, ms in enumerate(minutes, start=1):
        events = [ping("A", f"o{batch}-{i}", m * 60 if m < 60 else 3599, "IDLE") for i, m in enumerate(ms)]
        feed.add(*events)
        rows += [(batch, e["event_id"], e["timestamp"]) for e in events]
    stream = feed.stream(spark).withColumn("timestamp", F.try_to_timestamp("timestamp"))
    out = path("kept")
    kept = live.drop_copies(stream, "event_id", "timestamp").select("event_id")
    ingest.drain_to_parquet(kept, out, path("cp")).awaitTermination()
    df = spark.createDataFrame(rows, "batch int, event_id string, t string").withColumn("ts", F.try_to_timestamp("t"))
    twin = telemetry.late_data_split(df, "batch", "ts")
    assert twin.where("is_late").count() > 0
    assert {r.event_id for r in spark.read.parquet(out).collect()} == {r.event_id for r in twin.where("NOT is_late").collect()}


def test_split_stream_sets_late_events_aside(spark, path):
    minutes = [[0, 5], [30, 2], [21, 19, 40], [12, 29, 31, 50], [39, 40, 41, 20]]
    feed, rows = Feed(path("bronze"), schemas.TELEMETRY_EVENT), []
    for batch, ms in enumerate(minutes, start=1):
        events = [ping("A", f"o{batch}-{i}", m * 60, "IDLE") for i, m in enumerate(ms)]
        feed.add(*events)
        rows += [(batch, e["event_id"], e["timestamp"]) for e in events]
    kept, late = BatchTable(spark, path("kept")), live.LateEvents(spark, path("late"), F.try_to_timestamp("timestamp"))
    split = late.split(lambda df, n: kept.put(df, n), fold_every=2)
    live.start(feed.stream(spark), split, path("cp"), None).awaitTermination()
    late = late.late
    df = spark.createDataFrame(rows, "batch int, event_id string, t string").withColumn("ts", F.try_to_timestamp("t"))
    twin = telemetry.late_data_split(df, "batch", "ts")
    expected = {r.event_id for r in twin.where("is_late").collect()}
    assert expected and {r.event_id for r in late.read().collect()} == expected
    assert {r.event_id for r in kept.read().collect()} == {r[1] for r in rows} - expected


def test_rows_are_counted_while_they_are_written(spark, path):
    rows, seen = live.counted(spark.range(7), "written")
    rows.write.parquet(path())
    assert seen.get == {"rows": 7}


def test_spaced_events_whatever_the_batches(spark, path):
    minutes = [0, 4, 9, 21, 22, 33, 40, 41, 52]
    events = [ping("A", "o" if m % 2 else "p", m * 60, "IDLE") for m in minutes] + [ping("A", None, 60 * 55, "IDLE")]
    rows = [(e["event_id"], e["order_id"], e["timestamp"]) for e in events]
    df = spark.createDataFrame(rows, "event_id string, order_id string, t string").withColumn("ts", F.try_to_timestamp("t"))
    expected = {r.event_id for r in telemetry.dedup_window(df, "order_id", "ts", "event_id").collect()}
    assert 0 < len(expected) < len(events)
    for size in (1, 4, 10):
        feed = Feed(path("bronze"), schemas.TELEMETRY_EVENT)
        for k in range(0, len(events), size):
            feed.add(*events[k : k + size])
        stream = feed.stream(spark).select("event_id", "order_id", F.try_to_timestamp("timestamp").alias("ts"))
        last, out = live.LastSeen(spark, path("last"), "order_id", "ts", "event_id", buckets=4), BatchTable(spark, path("out"))
        live.spaced_events(stream, last, out, path("cp"), fold_every=3).awaitTermination()
        assert {r.event_id for r in out.read().collect()} == expected, size


def test_a_batch_of_orders_is_scanned_once_and_looks_at_no_log(spark, path):
    feed = Feed(path("bronze"), schemas.ORDER_EVENT).add(order("a"), order("b")).add(order("b", 9), order("c"))
    plans = []

    class Watched(BatchTable):
        def _write(self, rows, name):
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
            super()._write(rows, name)

    plain = live.orders_table(spark, path("log"))
    table = Watched(spark, plain.root, plain.combine, plain.at)
    live.live_orders(feed.stream(spark), table, path("cp"), every=None, keep_hours=None).awaitTermination()
    assert len(plans) == 2 and all(p.count("FileScan") + p.count("BatchScan") + p.count("Scan ExistingRDD") <= 1 for p in plans)
    assert all("parquet" not in p.lower() for p in plans)
    assert {r.order_id: r.order_timestamp.second for r in table.read().collect()} == {"a": 0, "b": 0, "c": 0}
