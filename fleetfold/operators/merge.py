"""Merges: slowly changing dimensions, latest state, field-wise folds.

All of them are pure functions of their inputs. The folds use only ``max`` and ``min`` over
event-time-stamped values, so any split of the input into batches, in any order and with
replays, ends in the same state.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetfold.functions.time import fixed_instant
from fleetfold.plans.ordered import MAX_GROUP_ROWS, with_position
from fleetfold.session import pin


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], first: bool = False) -> DataFrame:
    """The last (or first) row per key in the given order, combined before the shuffle.

    Rows that agree in ``order`` too are told apart by their other columns.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    picked = df.groupBy(*keys).agg((F.min(row) if first else F.max(row)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def insert_absent(target: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Staged rows whose key is known and not in the target. Null keys in the target do no harm."""
    return staged.where(F.col(key).isNotNull()).join(target.select(key), key, "left_anti")


def differs(left: str, right: str, columns: list[str]) -> Column:
    """Any of the columns differs between two struct columns; null equals null."""
    return reduce(
        lambda a, b: a | b,
        [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns],
        F.lit(False),
    )


def _side_by_side(target: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Both rows of a key as structs ``t`` and ``s``, null where a side has none."""
    t = target.select(key, F.struct(*target.columns).alias("t"))
    s = staged.where(F.col(key).isNotNull()).select(key, F.struct(*staged.columns).alias("s"))
    return t.join(s, key, "full_outer")


def changed_rows(target: DataFrame, staged: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """Staged rows whose tracked attributes differ from the target row of the same key."""
    both = _side_by_side(target, staged, key).where("t is not null and s is not null")
    return both.where(differs("t", "s", tracked)).select("s.*")


def surrogate_keys(
    rows: DataFrame, natural_key: str, name: str, after: int = 0, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Dense numbers ``after + 1 ...`` in the order of the natural key."""
    numbered = with_position(rows, [natural_key], "_position", max_group_rows)
    return numbered.withColumn(name, F.col("_position") + F.lit(after).cast("long")).drop("_position")


def highest(df: DataFrame, column: str) -> int:
    """Highest key in use; the unknown member's negative key does not count."""
    return max(df.agg(F.max(column)).first()[0] or 0, 0)


def scd1_merge(target: DataFrame, staged: DataFrame, key: str, surrogate: str | None = None) -> DataFrame:
    """Staged values win in every staged column; new keys are added; other columns keep their value.

    A key staged twice counts once.
    """
    staged_cols = set(staged.columns)
    staged = latest_per_key(staged.where(F.col(key).isNotNull()), [key], [c for c in staged.columns if c != key])
    both = _side_by_side(target, staged, key)
    has_s = F.col("s").isNotNull()

    def value(c: str) -> Column:
        old = F.col(f"t.{c}")
        if c not in staged_cols:
            return old.alias(c)
        new = F.col(f"s.{c}").cast(target.schema[c].dataType)
        return F.when(has_s, new).otherwise(old).alias(c)

    merged = both.select(*[value(c) for c in target.columns])
    return merged if surrogate is None else _number_new(merged, key, surrogate, highest(target, surrogate))


def _number_new(merged: DataFrame, key: str, surrogate: str, after: int) -> DataFrame:
    """Numbers for the rows that have none. The merge is written once, so the join behind it runs once."""
    merged = pin(merged, "merged")
    new = surrogate_keys(merged.where(F.col(surrogate).isNull()).drop(surrogate), key, surrogate, after)
    return merged.where(F.col(surrogate).isNotNull()).unionByName(new.select(*merged.columns))


# Fixed format: the attributes whose change opens a new courier version.
COURIER_TRACKED = [
    "courier_name", "vehicle", "vehicle_ownership", "equipment_set", "performance_level",
    "employment_status", "contract_type", "accident_risk_factor", "fatigue_resistance", "vehicle_range_km",
]


def scd2_merge(
    target: DataFrame,
    staged: DataFrame,
    key: str,
    tracked: list[str],
    as_of=None,
    surrogate: str | None = None,
) -> DataFrame:
    """Close the current version of every changed key and open one for changed and new keys.

    Staged values are cast to the target's types before they are compared, so 0.02 stays equal to
    0.02. Keys that are not staged stay open. A key staged twice counts once. The current slice
    and the staged rows meet in a single join; closed history is passed through unjoined. The clock
    is taken once per load, so a closed version ends exactly when its successor begins.

    A load that is older than what a key was last seen with is spliced into the key's history. Where the target has the
    column ``SEEN_AT``, the times of the loads that a version was seen in are kept there, and loads in any order give the
    same history; without it a version counts as seen when it began.
    """
    now = fixed_instant(as_of)
    versioning = ("valid_from", "valid_to", "is_current", SEEN_AT, surrogate)
    carried = [c for c in target.columns if c not in versioning and c in staged.columns]
    typed = staged.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in carried])
    typed = latest_per_key(typed.where(F.col(key).isNotNull()), [key], [c for c in carried if c != key])
    known, at = SEEN_AT in target.columns, target.schema["valid_from"].dataType

    tracked = [c for c in tracked if c in carried]
    after = 0 if surrogate is None else highest(target, surrogate)
    seen = F.coalesce(F.array_max(SEEN_AT), "valid_from") if known else F.col("valid_from")
    newer = target.where(F.col(key).isNotNull() & (seen >= now.cast(at)))
    spliced = None
    if not newer.isEmpty():
        late = pin(typed.select(key).join(newer.select(key).distinct(), key, "left_semi"), "late-keys")
        spliced = _spliced(target.join(late, key, "left_semi"), typed.join(late, key, "left_semi"), key, tracked, carried, now.cast(at), surrogate)
        target, typed = target.join(late, key, "left_anti"), typed.join(late, key, "left_anti")
    merged, history = _scd2_in_order(target, typed, key, tracked, carried, now, known)
    merged = merged if spliced is None else merged.unionByName(spliced)
    if surrogate is not None:
        merged = _number_new(merged, key, surrogate, after)
    return merged.unionByName(history)


SEEN_AT = "seen_at"


def _spliced(
    versions: DataFrame, staged: DataFrame, key: str, tracked: list[str], carried: list[str], now: Column, surrogate: str | None
) -> DataFrame:
    """Histories into which one more observation per key has been put, wherever its time falls.

    A history is taken apart into what was seen when, one row per load; what is staged replaces what was seen at the same
    time; neighbours that agree become one version again. A version keeps its surrogate as long as an observation that
    began it is part of it. Closed ends without a successor stay.
    """
    names = versions.columns
    seen = F.coalesce(F.col(SEEN_AT), F.array("valid_from")) if SEEN_AT in names else F.array("valid_from")
    row = F.struct(*names)
    old = versions.select(F.col(key).alias("_key"), F.explode(seen).alias("_at"), F.lit(0).alias("_new"), row.alias("_row"))
    fields = [(F.col(c) if c in carried else F.lit(None)).cast(versions.schema[c].dataType).alias(c) for c in names]
    new = staged.select(F.col(key).alias("_key"), now.alias("_at"), F.lit(1).alias("_new"), F.struct(*fields).alias("_row"))
    once = old.unionByName(new).groupBy("_key", "_at").agg(
        F.max_by("_row", "_new").alias("_row"), F.max("_new").alias("_new"),
        *([F.max(F.when(F.col("_row.valid_from") == F.col("_at"), F.col(f"_row.{surrogate}"))).alias("_surrogate")] if surrogate else []),
    )
    # A key has one row per load; its order is no matter of size.
    order = Window.partitionBy("_key").orderBy("_at")
    values = F.struct(*[F.col(f"_row.{c}").alias(c) for c in tracked])
    begins = F.lag("_at").over(order).isNull() | ~F.lag(values).over(order).eqNullSafe(values)
    numbered = once.withColumn("_begins", begins.cast("int")).withColumn("_version", F.sum("_begins").over(order))
    held = numbered.groupBy("_key", "_version").agg(
        F.min_by("_row", "_at").alias("_row"), F.min("_at").alias("_from"), F.sort_array(F.collect_set("_at")).alias("_seen"),
        F.max_by("_row.valid_to", "_at").alias("_end"), *([F.min("_surrogate").alias("_surrogate")] if surrogate else []),
    )
    ends = F.least(F.lead("_from").over(Window.partitionBy("_key").orderBy("_from")), "_end")
    held = held.withColumn("_to", ends)
    fixed = {"valid_from": F.col("_from"), "valid_to": F.col("_to"), "is_current": F.col("_to").isNull(), SEEN_AT: F.col("_seen")}
    if surrogate:
        fixed[surrogate] = F.col("_surrogate")
    return held.select(*[fixed.get(c, F.col(f"_row.{c}")).cast(versions.schema[c].dataType).alias(c) for c in names])


def _scd2_in_order(
    target: DataFrame, typed: DataFrame, key: str, tracked: list[str], carried: list[str], now: Column, known: bool
) -> tuple[DataFrame, DataFrame]:
    """The merge of rows that are newer than all that their keys were seen with, and the closed history.

    New versions have no surrogate yet.
    """
    is_open = F.col("is_current") & F.col(key).isNotNull()
    current, history = target.where(is_open), target.where(~F.coalesce(is_open, F.lit(False)))
    both = _side_by_side(current, typed, key)
    changed = F.col("t").isNotNull() & F.col("s").isNotNull() & differs("t", "s", tracked)

    def of_type(column: Column, name: str) -> Column:
        return column.cast(target.schema[name].dataType).alias(name)

    def old(name: str) -> Column:
        value = F.col(f"t.{name}")
        if name == "valid_to":
            return of_type(F.when(F.col("_changed"), now).otherwise(value), name)
        if name == "is_current":
            return of_type(F.when(F.col("_changed"), F.lit(False)).otherwise(value), name)
        if name == SEEN_AT and known:
            again = F.col("s").isNotNull() & ~F.col("_changed")
            so_far = F.coalesce(value, F.array("t.valid_from"))
            return of_type(F.when(again, F.array_append(so_far, now.cast(at))).otherwise(value), name)
        return value.alias(name)

    def new(name: str) -> Column:
        if name in carried:
            return F.col(f"s.{name}").alias(name)
        fixed = {"valid_from": now, "is_current": F.lit(True)} | ({SEEN_AT: F.array(now.cast(at))} if known else {})
        return of_type(fixed.get(name, F.lit(None)), name)

    names, at = target.columns, target.schema["valid_from"].dataType
    opens = F.col("s").isNotNull() & (F.col("t").isNull() | F.col("_changed"))
    rows = F.array(
        F.when(F.col("t").isNotNull(), F.struct(*[old(c) for c in names])),
        F.when(opens, F.struct(*[new(c) for c in names])),
    )
    merged = (
        both.withColumn("_changed", changed)
        .select(F.explode(F.array_compact(rows)).alias("_row"))
        .select(*[F.col(f"_row.{c}").alias(c) for c in names])
    )
    return merged, history


def upsert_latest(target: DataFrame | None, batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the newest of target and batch; an old event never replaces a newer one."""
    rows = batch if target is None else target.unionByName(batch)
    return latest_per_key(rows.where(F.col(key).isNotNull()), [key], order)


@dataclass(frozen=True)
class Policies:
    """What happens to each column when rows of one key meet.

    ``order`` is the event time with a tie-break. ``latest``: value of the newest row, null
    included. ``last_known``: newest non-null value. ``first``: value of the oldest row.
    ``greatest``: maximum. ``sticky_true``: true once it was true.
    """

    key: str
    order: tuple[str, ...]
    latest: tuple[str, ...] = ()
    last_known: tuple[str, ...] = ()
    first: tuple[str, ...] = ()
    greatest: tuple[str, ...] = ()
    sticky_true: tuple[str, ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return [*self.first, *self.latest, *self.last_known, *self.greatest, *self.sticky_true]


def fold_state(df: DataFrame, p: Policies) -> DataFrame:
    """Rows -> mergeable state, one row per key, combined on the map side.

    Rows without key or event time are left out, as they have no place in the order.
    """
    at = [F.col(c) for c in p.order]
    lifted = df.where(F.col(p.key).isNotNull() & at[0].isNotNull()).select(
        p.key,
        F.struct(*at, *p.latest).alias("latest"),
        F.struct(*at, *p.first).alias("first"),
        *[F.when(F.col(c).isNotNull(), F.struct(*at, c)).alias(f"known_{c}") for c in p.last_known],
        *[F.col(c).alias(f"max_{c}") for c in (*p.greatest, *p.sticky_true)],
    )
    return merge_states(lifted, p)


def merge_states(states: DataFrame, p: Policies) -> DataFrame:
    """States of one key -> one state. Associative and commutative."""
    keep = [c for c in states.columns if c not in (p.key, "first")]
    return states.groupBy(p.key).agg(F.min("first").alias("first"), *[F.max(c).alias(c) for c in keep])


def read_state(state: DataFrame, p: Policies) -> DataFrame:
    """State -> plain columns, with the event time of the newest row."""
    return state.select(
        p.key,
        *[F.col(f"first.{c}").alias(c) for c in p.first],
        *[F.col(f"latest.{c}").alias(c) for c in p.latest],
        *[F.col(f"known_{c}.{c}").alias(c) for c in p.last_known],
        *[F.col(f"max_{c}").alias(c) for c in (*p.greatest, *p.sticky_true)],
        F.col(f"latest.{p.order[0]}").alias("last_event_at"),
    )


def merge_with_policy(
    target_state: DataFrame | None, batch: DataFrame, p: Policies, reference_batching: bool = False
) -> DataFrame:
    """Field-wise upsert of a batch into the state.

    ``reference_batching`` first reduces the batch to the newest row per key, so that rows which
    are older than it within the batch take no part in maxima and known values.
    """
    if reference_batching:
        batch = latest_per_key(batch.where(F.col(p.key).isNotNull()), [p.key], list(p.order))
    state = fold_state(batch, p)
    if target_state is None:
        return state
    return merge_states(target_state.unionByName(state), p)


ORDER_PERFORMANCE = Policies(
    key="order_id",
    order=("gps_timestamp", "event_id"),
    first=("pizzeria_key", "customer_key", "zone_key", "date_key", "order_timestamp"),
    latest=("courier_key", "status_key", "outside_geofence", "is_completed"),
    last_known=("preparation_timestamp", "pickup_timestamp", "delivery_timestamp", "return_timestamp"),
    greatest=("total_distance", "total_time"),
)
