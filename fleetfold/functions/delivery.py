"""Delivery rules as column expressions: status wording, progress, service time, speed, demand."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetfold.functions.time import col, instant, seconds_between

# Fixed values of the delivery domain.
SLA_SECONDS = 120
FINISHED = ("DELIVERED", "RETURNING")
STATIONARY = ("IDLE", "PREPARING", "AT_CUSTOMER", "CRITICAL_FAILURE")
DISPLAY_STATUS = {
    "PREPARING": "KITCHEN_PREP",
    "IN_REALIZATION": "ON_ROUTE",
    "AT_CUSTOMER": "AT_DOOR",
    "DELIVERED": "COMPLETED",
    "RETURNING": "COMPLETED",
    "CRITICAL_FAILURE": "ISSUE",
}
DISPLAY_OTHER = "PENDING"
ROUTE_PROGRESS_CAP = 95.0
DEMAND_BY_FIRST_HOUR = {0: 0.30, 10: 0.98, 23: 0.50}


# Progress in percent of delivered orders, at the door, and in the kitchen.
DONE_PERCENT, AT_DOOR_PERCENT, PREPARING_PERCENT = 100.0, 99.0, 10.0


def _by_value(column: Column, mapping: dict, other) -> Column:
    out = None
    for value, result in mapping.items():
        out = (F if out is None else out).when(column == value, F.lit(result))
    return out.otherwise(F.lit(other))


def is_finished(status: Column | str) -> Column:
    return F.coalesce(col(status).isin(*FINISHED), F.lit(False))


def display_status(status: Column | str) -> Column:
    """Wording for readers of a report."""
    return _by_value(col(status), DISPLAY_STATUS, DISPLAY_OTHER)


def progress_percent(status, pickup_ts, as_of=None, sla_seconds: float = SLA_SECONDS) -> Column:
    """Progress of an order by status; on route it grows with the time since pickup, up to a cap."""
    status = col(status)
    on_route = F.round(seconds_between(pickup_ts, instant(as_of)) / F.lit(float(sla_seconds)) * 100, 2)
    return (
        F.when(is_finished(status), DONE_PERCENT)
        .when(status == "AT_CUSTOMER", AT_DOOR_PERCENT)
        .when((status == "IN_REALIZATION") & col(pickup_ts).isNotNull(), F.least(F.lit(ROUTE_PROGRESS_CAP), on_route))
        .when(status == "PREPARING", PREPARING_PERCENT)
        .otherwise(0.0)
    )


def average_speed_kmh(distance_km, seconds) -> Column:
    """Distance over time, 0 where no time has passed or it is unknown."""
    seconds = col(seconds).cast("double")
    return F.when(seconds > 0, F.round(col(distance_km).cast("double") / (seconds / 3600), 2)).otherwise(0.0)


def is_late(total_seconds, sla_seconds: float = SLA_SECONDS) -> Column:
    """Over the promised time; an unknown time is not late."""
    return F.coalesce(col(total_seconds) > F.lit(sla_seconds), F.lit(False))


def speed_kmh(speed_ms, status) -> Column:
    """Metres per second to km/h with one digit; 0 in every status that stands still."""
    return F.when(col(status).isin(*STATIONARY), 0.0).otherwise(F.round(col(speed_ms) * 3.6, 1))


def sla_clock(status, ping_ts, order_ts, delivery_ts, sla_seconds: float = SLA_SECONDS) -> tuple[Column, Column]:
    """Seconds left to the deadline, and whether it has passed.

    The clock stops at the delivery time once the order is delivered; without an order both are
    at rest (0, false).
    """
    until = F.when(is_finished(status), col(delivery_ts)).otherwise(col(ping_ts))
    left = F.lit(float(sla_seconds)) - seconds_between(order_ts, until)
    has_order = col(order_ts).isNotNull()
    return (
        F.when(has_order, F.round(left, 2)).otherwise(0.0),
        F.coalesce(has_order & (left < 0), F.lit(False)),
    )


def distance_left_km(status, km_to_target, trip_km) -> Column:
    """Way still to go: to the target on route, the whole trip before it, else nothing."""
    status = col(status)
    return (
        F.when(status == "IN_REALIZATION", F.round(col(km_to_target), 3))
        .when(status == "PREPARING", F.round(col(trip_km), 3))
        .otherwise(0.0)
    )


def realization_percent(status, left_km, trip_km) -> Column:
    """Share of the trip done, within [0, 99] on route; 99 at the door, 100 once delivered."""
    status, trip = col(status), col(trip_km)
    done = F.when(trip > 0, F.least(F.lit(AT_DOOR_PERCENT), F.greatest(F.lit(0.0), (1 - col(left_km) / trip) * 100))).otherwise(0.0)
    return F.round(
        F.when(is_finished(status), DONE_PERCENT)
        .when(status == "AT_CUSTOMER", AT_DOOR_PERCENT)
        .when(status == "IN_REALIZATION", done)
        .otherwise(0.0),
        2,
    )


def demand_factor(hour: Column | str) -> Column:
    """Expected order activity by hour of day."""
    hour, out = col(hour), F.lit(None).cast("double")
    for first, factor in DEMAND_BY_FIRST_HOUR.items():
        out = F.when(hour >= first, F.lit(factor)).otherwise(out)
    return out


def efficiency_class(vehicle_type, distance_km) -> Column:
    """High for a bike on a short way, Low for a car on a very short one, else Normal."""
    vehicle, distance = F.upper(col(vehicle_type)), col(distance_km)
    return (
        F.when(vehicle.contains("BIKE") & (distance < 3), "High")
        .when(vehicle.contains("CAR") & (distance < 1), "Low")
        .otherwise("Normal")
    )


def base_code_of(courier_code) -> Column:
    """Home base of a courier, read off the second part of the courier's code."""
    return F.concat(F.lit("PIZ-"), F.split_part(col(courier_code), F.lit("-"), F.lit(2)), F.lit("-001"))
