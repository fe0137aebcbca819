"""Distances and positions in degrees and kilometres."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetfold.functions.time import col

# Mean earth radius, and the upper distance bound (exclusive) of zones 1 to 4.
EARTH_RADIUS_KM = 6371.0
ZONE_BOUNDS_KM = (1.5, 3.0, 5.0, 8.0)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance. The half-chord is clamped so that rounding cannot leave [0, 1]."""
    phi1, phi2 = F.radians(col(lat1)), F.radians(col(lat2))
    half_phi = (phi2 - phi1) / 2
    half_lambda = F.radians(col(lon2) - col(lon1)) / 2
    chord = F.sin(half_phi) * F.sin(half_phi) + F.cos(phi1) * F.cos(phi2) * F.sin(half_lambda) * F.sin(half_lambda)
    chord = F.least(F.greatest(chord, F.lit(0.0)), F.lit(1.0))
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def zone_of(distance_km: Column | str, bounds=ZONE_BOUNDS_KM) -> Column:
    """1 for the innermost ring, len(bounds) + 1 beyond the last bound; null stays null."""
    distance = col(distance_km)
    return reduce(add, [(distance >= F.lit(bound)).cast("int") for bound in bounds]) + 1


def step_towards(lat, lon, to_lat, to_lon, step_km) -> tuple[Column, Column]:
    """Position after moving ``step_km`` on the straight line to a target, which is never passed."""
    distance = haversine_km(lat, lon, to_lat, to_lon)
    share = F.when(distance > 0, F.least(col(step_km) / distance, F.lit(1.0))).otherwise(F.lit(1.0))
    return (
        col(lat) + (col(to_lat) - col(lat)) * share,
        col(lon) + (col(to_lon) - col(lon)) * share,
    )


def grid_cell(degrees: Column | str, size: float) -> Column:
    return F.floor(col(degrees) / F.lit(size)).cast("long")
