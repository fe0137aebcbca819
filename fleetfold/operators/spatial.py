"""Zones, geofences, box search and nearest base, all by equi-joins on grid cells."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetfold.functions.geo import grid_cell, haversine_km, zone_of
from fleetfold.functions.time import col
from fleetfold.session import pin

# Fixed value: half the side of the search box, in degrees.
SEARCH_RADIUS_DEG = 0.025


def with_base_distance(points: DataFrame, base_lat, base_lon, digits: int = 6) -> DataFrame:
    """Add the distance to a base and the delivery zone it falls into."""
    distance = F.round(haversine_km("lat", "lon", base_lat, base_lon), digits)
    return points.withColumn("distance_km", distance).withColumn("zone_key", zone_of("distance_km"))


def geofence_flag(distance_km: Column | str, range_km: Column | str) -> Column:
    return col(distance_km) > col(range_km)


def _in_box(radius: float) -> Column:
    def near(axis: str) -> Column:
        return F.col(axis).between(F.col(f"_{axis}") - F.lit(radius), F.col(f"_{axis}") + F.lit(radius))

    return near("lat") & near("lon")


def _box_join(centres: DataFrame, points: DataFrame, radius: float) -> DataFrame:
    """``centres`` carry ``_lat, _lon``; ``points`` carry ``lat, lon``. The cell is a hair wider than
    the radius, so a box never reaches beyond the neighbouring cells, rounding included."""
    cell = radius * 1.001
    around = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    spread = (
        centres.withColumn("_dx", F.explode(around))
        .withColumn("_dy", F.explode(around))
        .withColumn("_cx", grid_cell("_lat", cell) + F.col("_dx"))
        .withColumn("_cy", grid_cell("_lon", cell) + F.col("_dy"))
        .drop("_dx", "_dy")
    )
    celled = points.withColumn("_cx", grid_cell("lat", cell)).withColumn("_cy", grid_cell("lon", cell))
    return celled.join(spread, ["_cx", "_cy"]).where(_in_box(radius)).drop("_cx", "_cy")


def pairs_in_box(bases: DataFrame, base_id: str, points: DataFrame, radius: float = SEARCH_RADIUS_DEG) -> DataFrame:
    """Each point with every base whose box holds it. Meant to be reduced right away."""
    centres = bases.select(base_id, F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    return _box_join(centres, points, radius).drop("_lat", "_lon")


CELL_BITS = 20  # how often a cell can be halved
FEW_IN_CELL = 64  # spots that are met one by one


def _halved(axis: str, cell: float, level: int = CELL_BITS) -> Column:
    """Index of a coordinate in the grid whose cells are ``cell`` halved ``level`` times; parents are exact."""
    finest = F.floor(F.col(axis) / F.lit(cell / (1 << CELL_BITS))).cast("long")
    return F.shiftright(finest, CELL_BITS - level)


def _cells(spots: DataFrame, cell: float, level: int) -> DataFrame:
    """Occupied cells of a level with the cell above, the box and number of their spots, and their points."""
    up = max(level - 1, 0)
    keys = {"_cx": _halved("lat", cell, level), "_cy": _halved("lon", cell, level), "_ux": _halved("lat", cell, up), "_uy": _halved("lon", cell, up)}
    return spots.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
        F.min("lat").alias("_lat0"), F.max("lat").alias("_lat1"), F.min("lon").alias("_lon0"), F.max("lon").alias("_lon1"),
        F.sum("_n").alias("_points"), F.count(F.lit(1)).alias("_spots"),
    )


def _edge(axis: str, sign: int, radius: float) -> Column:
    return F.col(f"_{axis}") + F.lit(sign * radius)


def count_in_box(
    bases: DataFrame, base_id: str, points: DataFrame, radius: float = SEARCH_RADIUS_DEG, few: int = FEW_IN_CELL
) -> DataFrame:
    """Number of points in the box of each base that has any.

    Points and bases on one spot are counted before the join, so copies do not multiply. A cell whose spots all lie in
    the box is added as a whole. One that lies in part is halved, where it has more than a few spots, and otherwise met
    spot by spot; so a box meets the cells along its edge and not the spots inside, however many a cell has.
    """
    cell = radius * 1.001  # a hair wider than the radius, so that a box reaches the neighbouring cells at most
    spots = pin(points.where("lat is not null and lon is not null").groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("_n")), "spots")
    centres = bases.where("lat is not null and lon is not null").select(F.col("lat").alias("_lat"), F.col("lon").alias("_lon")).distinct()
    around = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    spread = centres.withColumn("_dx", F.explode(around)).withColumn("_dy", F.explode(around)).select(
        "_lat", "_lon", (_halved("_lat", cell, 0) + F.col("_dx")).alias("_ux"), (_halved("_lon", cell, 0) + F.col("_dy")).alias("_uy")
    )
    counts = []
    for level in range(CELL_BITS + 1):
        met = spread.join(_cells(spots, cell, level), ["_ux", "_uy"])
        low, high = {a: _edge(a, -1, radius) for a in ("lat", "lon")}, {a: _edge(a, 1, radius) for a in ("lat", "lon")}
        apart = [(F.col(f"_{a}1") < low[a]) | (F.col(f"_{a}0") > high[a]) for a in ("lat", "lon")]
        within = [(F.col(f"_{a}0") >= low[a]) & (F.col(f"_{a}1") <= high[a]) for a in ("lat", "lon")]
        met = met.where(~(apart[0] | apart[1])).withColumn("_whole", within[0] & within[1])
        met = pin(met.select("_lat", "_lon", "_cx", "_cy", "_points", "_spots", "_whole"), "boxes-and-cells")
        counts.append(met.where("_whole").select("_lat", "_lon", F.col("_points").alias("_n")))
        split = ~F.col("_whole") & (F.col("_spots") > few) & F.lit(level < CELL_BITS)
        last = met.where(~F.col("_whole") & ~split).select("_lat", "_lon", "_cx", "_cy")
        celled = spots.withColumns({"_cx": _halved("lat", cell, level), "_cy": _halved("lon", cell, level)})
        counts.append(celled.join(last, ["_cx", "_cy"]).where(_in_box(radius)).select("_lat", "_lon", "_n"))
        spread = met.where(split).select("_lat", "_lon", F.col("_cx").alias("_ux"), F.col("_cy").alias("_uy"))
        if spread.isEmpty():
            break
    counted = reduce(DataFrame.unionByName, counts).groupBy("_lat", "_lon").agg(F.sum("_n").alias("points"))
    named = bases.select(base_id, F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    return named.join(counted, ["_lat", "_lon"]).drop("_lat", "_lon")


def sample_one_per_group(df: DataFrame, group: str, item: str, seed: str) -> DataFrame:
    """One row per group, drawn evenly by a seeded hash of the item, so that reruns agree."""
    draw = F.md5(F.concat_ws("|", F.lit(seed), F.col(group).cast("string"), F.col(item).cast("string")))
    rest = [c for c in df.columns if c not in (group, item)]
    row = F.struct(draw.alias("_draw"), item, *rest)
    picked = df.groupBy(group).agg(F.min(row).alias("_row"))
    return picked.select(*[group if c == group else F.col(f"_row.{c}").alias(c) for c in df.columns])


GRID_BITS = 21  # cells per axis at the finest level: three numbers fit one key
FIRST_LEVEL = 3
FEW_PER_SPOT = 8  # pairs of a position and a site, on average, at which splitting ends
SLACK = 1e-9  # chords on the unit sphere; far more than rounding, far less than the last digit of a distance


def _on_sphere(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Add the point on the unit sphere: chords order as distances do, with no seam at the date line and none at the poles."""
    phi, lam = F.radians(lat), F.radians(lon)
    return df.withColumns({"_x": F.cos(phi) * F.cos(lam), "_y": F.cos(phi) * F.sin(lam), "_z": F.sin(phi)})


def _in_cube(df: DataFrame, low: list[float], extent: float) -> DataFrame:
    """Add the finest cell of each point, as three numbers."""
    top = (1 << GRID_BITS) - 1
    cell = lambda axis, least: F.least(F.floor((F.col(axis) - least) / extent * (top + 1)), F.lit(top)).cast("long")
    return df.withColumns({f"_i{axis[1]}": cell(axis, least) for axis, least in zip(("_x", "_y", "_z"), low)})


def _node(level: int) -> Column:
    """Key of the cell of a level that holds a point."""
    shift = GRID_BITS - level
    part = lambda axis: F.shiftright(f"_i{axis}", shift)
    return F.shiftleft(part("x"), 2 * GRID_BITS).bitwiseOR(F.shiftleft(part("y"), GRID_BITS)).bitwiseOR(part("z"))


def _nodes(points: DataFrame, level: int, above: int, side: str) -> DataFrame:
    """Occupied cells of a level: key, key of the cell above, the box of the points inside, and their number."""
    parent = _node(above) if above else F.lit(0).cast("long")
    bounds = [f(f"_{axis}").alias(f"{side}_{name}{axis}") for axis in "xyz" for name, f in (("lo", F.min), ("hi", F.max))]
    return points.groupBy(_node(level).alias(f"{side}_key"), parent.alias(f"{side}_up")).agg(F.count(F.lit(1)).alias(f"{side}_n"), *bounds)


def _least_gap() -> Column:
    gaps = [F.greatest(F.lit(0.0), F.col(f"s_lo{a}") - F.col(f"t_hi{a}"), F.col(f"t_lo{a}") - F.col(f"s_hi{a}")) for a in "xyz"]
    return F.sqrt(sum(g * g for g in gaps))


def _greatest_gap() -> Column:
    gaps = [F.greatest(F.col(f"s_hi{a}") - F.col(f"t_lo{a}"), F.col(f"t_hi{a}") - F.col(f"s_lo{a}")) for a in "xyz"]
    return F.sqrt(sum(g * g for g in gaps))


def candidates_per_spot(spots: DataFrame, sites: DataFrame, few: float = FEW_PER_SPOT) -> DataFrame:
    """Positions (``lat``, ``lon``) with the sites (``_lat``, ``_lon``, ``_id``) that may be their nearest.

    Two trees of cells on the sphere are walked down together, one over positions and one over sites, level by level. A
    pair of cells is kept if its least distance is no more than the smallest greatest distance that any pair of the same
    cell of positions has: all positions in there have a site at least that near. Both cells of a pair are split in the
    next level. Distances are those of the boxes of the points inside, so a cell with one point is exact. Splitting ends
    when few pairs of points are left; they are never formed before.
    """
    spots, sites = _on_sphere(spots, "lat", "lon"), _on_sphere(sites, "_lat", "_lon")
    axes = ("_x", "_y", "_z")
    every = spots.select(*axes).unionByName(sites.select(*axes))
    found = every.agg(*[F.min(a) for a in axes], *[F.max(a) for a in axes]).first()
    if found[0] is None:
        return spots.join(sites, F.lit(False)).select("lat", "lon", "_lat", "_lon", "_id")
    low, extent = list(found[:3]), max(max(b - a for a, b in zip(found[:3], found[3:])), 1e-12)
    spots, sites = pin(_in_cube(spots, low, extent), "spots"), pin(_in_cube(sites, low, extent), "sites")
    total = spots.count()

    root = spots.sparkSession.range(1).select(F.lit(0).cast("long").alias("s_up"), F.lit(0).cast("long").alias("t_up"))
    pairs, above, level = root, 0, FIRST_LEVEL
    while True:
        split = pairs.join(_nodes(spots, level, above, "s"), "s_up").join(_nodes(sites, level, above, "t"), "t_up")
        gaps = pin(split.select("s_key", "t_key", "s_n", "t_n", _least_gap().alias("_least"), _greatest_gap().alias("_most")), "node-pairs")
        reach = gaps.groupBy("s_key").agg(F.min("_most").alias("_reach"))
        kept = gaps.join(reach, "s_key").where(F.col("_least") <= F.col("_reach") + SLACK)
        pairs = pin(kept.select(F.col("s_key").alias("s_up"), F.col("t_key").alias("t_up"), (F.col("s_n") * F.col("t_n")).alias("_met")), "kept-pairs")
        met = pairs.agg(F.sum("_met")).first()[0] or 0
        pairs = pairs.drop("_met")
        if met <= few * total or level == GRID_BITS:
            break
        above, level = level, level + 1
    here = spots.select("lat", "lon", _node(level).alias("s_up")).join(pairs, "s_up")
    return here.join(sites.select("_lat", "_lon", "_id", _node(level).alias("t_up")), "t_up").select("lat", "lon", "_lat", "_lon", "_id")


FEW_SITES = 64


def nearest_base(points: DataFrame, bases: DataFrame, base_id: str, digits: int = 6, few_sites: int = FEW_SITES) -> DataFrame:
    """Points with the id and distance of their nearest base; equal rounded distance: lowest id.

    Bases on one spot count once. A few bases are compared with each point in place, without a join. Of more, the search
    runs once per position, so a position that a third of all points share costs one search.
    """
    sites = bases.where("lat is not null and lon is not null").groupBy(F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    sites = pin(sites.agg(F.min(base_id).alias("_id")), "sites")
    known = F.col("lat").isNotNull() & F.col("lon").isNotNull()

    def distance(lat, lon) -> Column:
        return F.round(haversine_km("lat", "lon", lat, lon), digits)

    few = sites.limit(few_sites + 1).collect()
    if len(few) <= few_sites:
        kind = sites.schema["_id"].dataType
        each = [F.struct(distance(F.lit(r["_lat"]), F.lit(r["_lon"])).alias("km"), F.lit(r["_id"]).cast(kind).alias("id")) for r in few]
        near = F.array_min(F.array(*each)) if each else F.lit(None).cast(f"struct<km:double,id:{kind.simpleString()}>")
        found = points.withColumn("_near", F.when(known, near))
        return found.withColumns({base_id: F.col("_near.id"), "distance_km": F.col("_near.km")}).drop("_near")
    spots = points.where(known).select("lat", "lon").distinct()
    found = (
        candidates_per_spot(spots, sites)
        .groupBy("lat", "lon")
        .agg(F.min(F.struct(distance("_lat", "_lon").alias("km"), F.col("_id").alias("id"))).alias("_near"))
        .select("lat", "lon", F.col("_near.id").alias(base_id), F.col("_near.km").alias("distance_km"))
    )
    return points.join(found, ["lat", "lon"], "left")
