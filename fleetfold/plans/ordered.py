"""Ordered scans (previous row, running total, row position) that no hot key can stall.

A window over a key sends the whole group to one task. That is right for groups of ordinary size,
so the largest group is measured first (a count per key, combined on the map side). Beyond the
limit the rows are cut into even ranges of (key, order) whatever the key, the window runs inside
each range, and one row per range carries the state over the cut. The number of ranges is bounded by the
cores of the cluster, not by the data, so that table is safe to broadcast.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetfold.session import pin

RANGE = "__range"
MAX_GROUP_ROWS = 2_000_000
ROUNDS = 16  # ranges per core of the cluster at most; beyond that ranges hold more rows


def group_sizes(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Rows of the largest group, and of all. Without keys the whole table is one group."""
    sizes = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
    return sizes[0] or 0, sizes[1] or 0


def _range_count(df: DataFrame, total: int, max_group_rows: int) -> int:
    """As many ranges as the rows ask for, but no more than the cluster works on in a few rounds: bounds are
    sampled on the driver, and one row per range is carried on, so their number must not grow with the data."""
    at_least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at_most = max(at_least, ROUNDS * df.sparkSession.sparkContext.defaultParallelism)
    return min(max(at_least, math.ceil(total / max(max_group_rows, 1_000_000))), at_most)


class Ordered:
    """Rows in (key, order), measured and cut into ranges once for all scans over them.

    ``order`` must be unique within a key; rows that agree in it must not matter to the measures.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], max_group_rows: int = MAX_GROUP_ROWS):
        self.keys, self.order = keys, order
        self.columns = df.columns
        largest, total = group_sizes(df, keys)
        self.cut = max_group_rows <= 0 or largest > max_group_rows
        if self.cut:
            # Even ranges whatever the key; pinned, since range bounds are sampled and must not move.
            ranged = df.repartitionByRange(_range_count(df, total, max_group_rows), *keys, *order)
            df = pin(ranged.withColumn(RANGE, F.spark_partition_id()), "ranges")
        self.df = df
        self.key = F.struct(*keys) if keys else F.struct(F.lit(0))

    def result(self) -> DataFrame:
        return self.df.select(*self.columns)

    def _with(self, df: DataFrame, columns: list[str]) -> Ordered:
        out = copy.copy(self)
        out.df, out.columns = df, columns
        return out

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Ordered:
        """Add or drop columns, row by row; keys and order must stay."""
        df = change(self.df)
        return self._with(df, [c for c in df.columns if c != RANGE])

    def previous(self, columns: list[str], prefix: str = "prev_") -> Ordered:
        """Add the values of ``columns`` in the preceding row of the same key; null in the first row."""
        row = F.struct(*columns)
        if not self.cut:
            before = self.df.withColumn("__before", F.lag(row).over(Window.partitionBy(*self.keys).orderBy(*self.order)))
        else:
            # The last row of each range, seen from the next range that has rows: one row per range.
            tails = self.df.groupBy(RANGE).agg(
                F.max(F.struct(self.key.alias("key"), F.struct(*self.order).alias("at"), row.alias("row"))).alias("tail")
            )
            carried = tails.select(RANGE, F.lag("tail").over(Window.orderBy(RANGE)).alias("__carried"))
            inside = F.lag(row).over(Window.partitionBy(RANGE, *self.keys).orderBy(*self.order))
            reaches = F.col("__carried.key").eqNullSafe(self.key)
            before = (
                self.df.withColumn("__inside", inside)
                .join(F.broadcast(carried), RANGE, "left")
                .withColumn("__before", F.coalesce("__inside", F.when(reaches, F.col("__carried.row"))))
                .drop("__inside", "__carried")
            )
        added = before.withColumns({prefix + c: F.col(f"__before.{c}") for c in columns}).drop("__before")
        return self._with(added, [*self.columns, *[prefix + c for c in columns]])

    def running(self, measures: dict[str, tuple[str, str]]) -> Ordered:
        """Add running aggregates up to and including each row: ``{name: ("sum" | "max", column)}``.

        Without keys the order spans the whole table, which is then the group that was measured. Sums should be
        over integers or decimals, so that their order does not matter.
        """

        def over(kind: str, column: Column | str, window) -> Column:
            return getattr(F, kind)(column).over(window)

        so_far = (Window.unboundedPreceding, Window.currentRow)
        if not self.cut:
            window = Window.partitionBy(*self.keys).orderBy(*self.order).rowsBetween(*so_far)
            added = {name: over(kind, c, window) for name, (kind, c) in measures.items()}
            return self._with(self.df.withColumns(added), [*self.columns, *measures])

        totals = self.df.groupBy(RANGE, *self.keys).agg(
            *[getattr(F, kind)(c).alias(name) for name, (kind, c) in measures.items()]
        )
        earlier = Window.partitionBy(*self.keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        # A key reaches back over a range's start in at most one case per range, its first key: one row per range.
        carried = totals.select(
            RANGE,
            self.key.alias("__key"),
            F.count(F.lit(1)).over(earlier).alias("__earlier"),
            *[over(kind, name, earlier).alias(f"__{name}") for name, (kind, _) in measures.items()],
        ).where("__earlier > 0")
        inside = Window.partitionBy(RANGE, *self.keys).orderBy(*self.order).rowsBetween(*so_far)
        joined = self.df.withColumns({f"__in_{name}": over(kind, c, inside) for name, (kind, c) in measures.items()}).join(
            F.broadcast(carried), RANGE, "left"
        )
        reaches = F.col("__key").eqNullSafe(self.key)
        merged = {
            name: _MERGE[kind](F.col(f"__in_{name}"), F.when(reaches, F.col(f"__{name}")))
            for name, (kind, _) in measures.items()
        }
        added = joined.withColumns(merged)
        kept = [*self.columns, *measures]
        return self._with(added.select(*kept, RANGE), kept)


def with_previous(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[str],
    prefix: str = "prev_",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The values of ``columns`` in the preceding row of the same key; null in the first row."""
    return Ordered(df, keys, order, max_group_rows).previous(columns, prefix).result()


_MERGE = {"sum": lambda a, b: F.coalesce(a + b, a, b), "max": lambda a, b: F.greatest(a, b)}


def with_running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    measures: dict[str, tuple[str, str]],
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Running aggregates up to and including each row; see ``Ordered.running``."""
    return Ordered(df, keys, order, max_group_rows).running(measures).result()


def with_position(
    df: DataFrame, order: list[str], name: str = "position", max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Dense row number 1..n over the whole table in the given unique order."""
    ones = df.withColumn("__one", F.lit(1).cast("long"))
    return with_running(ones, [], order, {name: ("sum", "__one")}, max_group_rows).drop("__one")
