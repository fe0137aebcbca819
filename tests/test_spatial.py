"""Geography against brute force in plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fleetfold.functions import delivery as rules
from fleetfold.functions.geo import haversine_km, step_towards, zone_of
from fleetfold.operators import spatial


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371.0 * math.atan2(math.sqrt(min(h, 1)), math.sqrt(1 - min(h, 1)))


def test_distance_at_the_extremes(spark):
    pairs = [((0.0, 0.0), (0.0, 0.0)), ((0.0, 0.0), (0.0, 180.0)), ((90.0, 0.0), (-90.0, 0.0)), ((52.1, 21.0), (41.9, 12.5))]
    df = spark.createDataFrame([(*a, *b) for a, b in pairs], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got == pytest.approx([km(a, b) for a, b in pairs], abs=1e-6)
    assert got[0] == 0.0 and got[1] == pytest.approx(math.pi * 6371)


def test_zone_bounds_belong_to_the_outer_zone(spark):
    cases = {0.0: 1, 1.4999: 1, 1.5: 2, 2.9: 2, 3.0: 3, 4.9: 3, 5.0: 4, 7.99: 4, 8.0: 5, 100.0: 5, None: None}
    df = spark.createDataFrame([(d,) for d in cases], "d double").select("d", zone_of("d").alias("z"))
    assert {r.d: r.z for r in df.collect()} == cases


def test_step_never_passes_the_target(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1e6,)], "step double")
    lat, lon = step_towards(F.lit(52.0), F.lit(21.0), F.lit(52.1), F.lit(21.1), "step")
    got = [tuple(r) for r in df.select(lat, lon).collect()]
    assert got[0] == (52.0, 21.0) and got[2] == pytest.approx((52.1, 21.1))
    assert km((52.0, 21.0), got[1]) == pytest.approx(1.0, rel=1e-3)
    here, there = step_towards(F.lit(1.0), F.lit(1.0), F.lit(1.0), F.lit(1.0), F.lit(5.0))
    assert tuple(spark.range(1).select(here, there).first()) == (1.0, 1.0)


def world(rng, n):
    out = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n)]
    out += [(90.0, 0.0), (-90.0, 10.0), (0.0, 180.0), (0.0, -180.0), (10.0, 0.0), (-0.1, 0.1)]
    out += [(52.2 + rng.uniform(-0.05, 0.05), 21.0 + rng.uniform(-0.05, 0.05)) for _ in range(n)]
    return out


@pytest.mark.parametrize("few_sites", [0, 1000])
@pytest.mark.parametrize("sites", [1, 60])
def test_nearest_base_on_the_whole_globe(spark, sites, few_sites):
    rng = random.Random(sites)
    points = world(rng, 60) + [(0.0, 0.0)] * 80  # a third of the points share one position
    bases = [(i, *p) for i, p in enumerate(world(rng, sites))][: sites * 2]
    bases += [(900, *bases[0][1:])]  # two bases on one spot: the lower id wins
    p = spark.createDataFrame([(i, *xy) for i, xy in enumerate(points)] + [(9999, None, 1.0)], "id int, lat double, lon double")
    b = spark.createDataFrame(bases, "base int, lat double, lon double")
    got = {r.id: (r.base, r.distance_km) for r in spatial.nearest_base(p, b, "base", few_sites=few_sites).collect()}
    assert len(got) == len(points) + 1 and got[9999] == (None, None)
    for i, xy in enumerate(points):
        best, base = min((round(km(xy, q), 6), n) for n, *q in bases)
        assert got[i][1] == pytest.approx(best, abs=2e-6), (xy, got[i], base)
        assert got[i][0] == base or round(km(xy, bases[got[i][0]][1:]), 5) == round(best, 5)


def test_box_search_with_edges_and_negative_coordinates(spark):
    rng = random.Random(3)
    r = 0.025
    centres = [(0, 0.0, 0.0), (1, -0.025, 0.0125), (2, 52.23, 21.01), (3, 52.23, 21.01), (4, -33.9, -70.6)]
    points = []
    for _, lat, lon in centres:
        points += [(lat + dx, lon + dy) for dx in (-r, 0.0, r) for dy in (-r, 0.0, r)]
        points += [(lat + rng.uniform(-0.06, 0.06), lon + rng.uniform(-0.06, 0.06)) for _ in range(60)]
    points += [(52.231, 21.011)] * 150
    p = spark.createDataFrame([(i, *xy) for i, xy in enumerate(points)], "id int, lat double, lon double")
    b = spark.createDataFrame(centres, "base int, lat double, lon double")
    expected = {
        (n, i)
        for n, lat, lon in centres
        for i, (x, y) in enumerate(points)
        if lat - r <= x <= lat + r and lon - r <= y <= lon + r
    }
    assert {(x.base, x.id) for x in spatial.pairs_in_box(b, "base", p, r).collect()} == expected
    counts = {n: sum(1 for m, _ in expected if m == n) for n, *_ in centres}
    for few in (0, 5, 1000):
        assert {x.base: x.points for x in spatial.count_in_box(b, "base", p, r, few).collect()} == counts


def test_sample_is_one_per_group_and_repeatable(spark):
    df = spark.createDataFrame([(g, i) for g in range(20) for i in range(50)], "g int, i int")
    one = spatial.sample_one_per_group(df, "g", "i", "s")
    again = spatial.sample_one_per_group(df.repartition(5), "g", "i", "s")
    other = spatial.sample_one_per_group(df, "g", "i", "t")
    assert one.count() == 20
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, again.collect()))
    assert sorted(map(tuple, one.collect())) != sorted(map(tuple, other.collect()))


def test_status_rules(spark):
    statuses = ["IDLE", "PREPARING", "IN_REALIZATION", "AT_CUSTOMER", "DELIVERED", "RETURNING", "CRITICAL_FAILURE", None]
    df = spark.createDataFrame([(s,) for s in statuses], "s string").select(
        "s",
        rules.display_status("s").alias("shown"),
        rules.progress_percent("s", F.lit("2026-01-01 00:00:00").cast("timestamp"), "2026-01-01 00:01:00").alias("progress"),
        rules.progress_percent("s", F.lit(None).cast("timestamp"), "2026-01-01 00:01:00").alias("no_pickup"),
        rules.speed_kmh(F.lit(10.0), "s").alias("speed"),
        rules.distance_left_km("s", F.lit(1.23456), F.lit(9.87654)).alias("left"),
        rules.realization_percent("s", F.lit(1.0), F.lit(4.0)).alias("done"),
        rules.realization_percent("s", F.lit(9.0), F.lit(4.0)).alias("behind"),
        rules.realization_percent("s", F.lit(1.0), F.lit(0.0)).alias("no_trip"),
        rules.is_finished("s").alias("finished"),
    )
    got = {r.s: r for r in df.collect()}
    shown = ["PENDING", "KITCHEN_PREP", "ON_ROUTE", "AT_DOOR", "COMPLETED", "COMPLETED", "ISSUE", "PENDING"]
    assert [got[s].shown for s in statuses] == shown
    assert [got[s].progress for s in statuses] == [0, 10, 50, 99, 100, 100, 0, 0]
    assert got["IN_REALIZATION"].no_pickup == 0
    assert [got[s].speed for s in statuses] == [0, 0, 36, 0, 36, 36, 0, 36]
    assert [got[s].left for s in statuses] == [0, 9.877, 1.235, 0, 0, 0, 0, 0]
    assert [got[s].done for s in statuses] == [0, 0, 75, 99, 100, 100, 0, 0]
    assert got["IN_REALIZATION"].behind == 0 and got["IN_REALIZATION"].no_trip == 0
    assert [got[s].finished for s in statuses] == [False, False, False, False, True, True, False, False]


def test_progress_is_capped_on_route(spark):
    at = F.lit("2026-01-01 00:00:00").cast("timestamp")
    assert spark.range(1).select(rules.progress_percent(F.lit("IN_REALIZATION"), at, "2026-01-01 09:00:00")).first()[0] == 95.0


def test_service_clock(spark):
    rows = [
        ("DELIVERED", "2026-01-01 00:09:00", "2026-01-01 00:00:00", "2026-01-01 00:01:30.5"),
        ("PREPARING", "2026-01-01 00:02:00", "2026-01-01 00:00:00", None),
        ("AT_CUSTOMER", "2026-01-01 00:02:01", "2026-01-01 00:00:00", None),
        ("IDLE", "2026-01-01 00:02:01", None, None),
    ]
    df = spark.createDataFrame(rows, "s string, p string, o string, d string")
    left, late = rules.sla_clock("s", F.col("p").cast("timestamp"), F.col("o").cast("timestamp"), F.col("d").cast("timestamp"))
    got = [tuple(r) for r in df.select(left, late).collect()]
    assert got == [(29.5, False), (0.0, False), (-1.0, True), (0.0, False)]


def test_guarded_speed_demand_and_efficiency(spark):
    df = spark.createDataFrame([(0.0,), (None,), (-5.0,), (1800.0,)], "t double")
    assert [r[0] for r in df.select(rules.average_speed_kmh(F.lit(2.5), "t")).collect()] == [0.0, 0.0, 0.0, 5.0]
    hours = spark.range(24).select(rules.demand_factor("id")).collect()
    assert [h[0] for h in hours] == [0.30] * 10 + [0.98] * 13 + [0.50]
    cases = [("bike", 2.9, "High"), ("E-Bike", 0.5, "High"), ("bike", 3.0, "Normal"), ("car", 0.9, "Low"),
             ("car", 1.0, "Normal"), ("scooter", 0.1, "Normal"), (None, 0.1, "Normal"), ("bike", None, "Normal")]
    df = spark.createDataFrame([c[:2] for c in cases], "v string, d double")
    assert [r[0] for r in df.select(rules.efficiency_class("v", "d")).collect()] == [c[2] for c in cases]
    codes = spark.createDataFrame([("C-WAW-01",), ("odd",), (None,)], "c string").select(rules.base_code_of("c"))
    assert [r[0] for r in codes.collect()] == ["PIZ-WAW-001", "PIZ--001", None]


def test_few_pairs_meet_where_points_and_sites_are_dense(spark):
    points = spark.range(4000).select((52.0 + (F.col("id") % 200) * 0.001).alias("lat"), (21.0 + F.floor(F.col("id") / 200) * 0.01).alias("lon"))
    sites = spark.range(100).select(
        (52.0 + (F.col("id") % 10) * 0.02).alias("_lat"), (21.0 + F.floor(F.col("id") / 10) * 0.02).alias("_lon"), F.col("id").alias("_id")
    )
    pairs = spatial.candidates_per_spot(points, sites)
    assert pairs.select("lat", "lon").distinct().count() == 4000
    assert pairs.count() < 0.06 * 4000 * 100


def test_a_hundred_thousand_spots_and_sites_meet_rarely(spark):
    """Spread over the globe, and half of both in one town; checked against a plain search for some."""
    rng = random.Random(11)
    place = lambda k: (rng.uniform(-90, 90), rng.uniform(-180, 180)) if k % 2 else (52.2 + rng.gauss(0, 0.05), 21.0 + rng.gauss(0, 0.05))
    spots = spark.createDataFrame([place(k) for k in range(100_000)], "lat double, lon double")
    sites = spark.createDataFrame([(k, *place(k)) for k in range(100_000)], "base int, lat double, lon double")
    named = sites.select(F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), F.col("base").alias("_id"))
    spots, named = spatial.pin(spots, "spots"), spatial.pin(named, "named")
    pairs = spatial.pin(spatial.candidates_per_spot(spots, named), "pairs")
    assert pairs.count() < 10 * 100_000
    best = pairs.groupBy("lat", "lon").agg(F.min(haversine_km("lat", "lon", "_lat", "_lon")).alias("km"))
    assert best.count() == 100_000
    all_sites = [(r._lat, r._lon) for r in named.collect()]
    for r in best.limit(20).collect():
        assert r.km == pytest.approx(min(km((r.lat, r.lon), q) for q in all_sites), abs=1e-6)


def test_nearest_base_of_nothing(spark):
    points = spark.createDataFrame([(1, 1.0, 1.0)], "id int, lat double, lon double")
    none = spark.createDataFrame([], "base int, lat double, lon double")
    for few_sites in (-1, 64):
        assert [(r.base, r.distance_km) for r in spatial.nearest_base(points, none, "base", few_sites=few_sites).collect()] == [(None, None)]
        assert spatial.nearest_base(none.withColumnRenamed("base", "id"), points.withColumnRenamed("id", "base"), "base", few_sites=few_sites).count() == 0


def test_a_cell_with_most_spots_is_not_met_spot_by_spot(spark, monkeypatch):
    """Nine of ten spots in one cell, and boxes of fifty bases that reach into it."""
    rng = random.Random(12)
    spots = [(52.2 + rng.random() * 0.02, 21.0 + rng.random() * 0.02) if k % 10 else (50 + rng.random() * 4, 20 + rng.random() * 4) for k in range(20_000)]
    bases = [(k, 52.2 + rng.uniform(-0.03, 0.05), 21.0 + rng.uniform(-0.03, 0.05)) for k in range(50)]
    p = spark.createDataFrame(spots, "lat double, lon double")
    b = spark.createDataFrame(bases, "base int, lat double, lon double")
    met = []
    pinned = spatial.pin

    def watching(df, name):
        out = pinned(df, name)
        if name == "boxes-and-cells":
            met.append((out.count(), out.where("not _whole and _spots <= 64").agg(F.sum("_spots")).first()[0] or 0))
        return out

    monkeypatch.setattr(spatial, "pin", watching)
    got = {x.base: x.points for x in spatial.count_in_box(b, "base", p).collect()}
    r = spatial.SEARCH_RADIUS_DEG
    expected = {n: sum(1 for x, y in spots if lat - r <= x <= lat + r and lon - r <= y <= lon + r) for n, lat, lon in bases}
    assert got == {n: c for n, c in expected.items() if c}
    pairs = sum(expected.values())
    assert sum(cells + spots for cells, spots in met) < 0.25 * pairs and pairs > 100_000
