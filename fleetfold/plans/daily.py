"""The daily batch run: dimensions, silver drains, gold dimensions, key figures, compaction."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold import schemas
from fleetfold.operators import dims
from fleetfold.operators.clean import enforce_types
from fleetfold.operators.kpi import daily_kpi
from fleetfold.operators.merge import COURIER_TRACKED, SEEN_AT, scd1_merge, scd2_merge
from fleetfold.session import scratch_scope
from fleetfold.sources.files import read_csv
from fleetfold.sources.compaction import CompactedTable
from fleetfold.sources.tables import MAX_ROWS_PER_FILE, VersionedTable, replace_partitions
from fleetfold.storage import path_exists
from fleetfold.streaming.ingest import silver_orders, silver_telemetry


@dataclass(frozen=True)
class DimensionSpec:
    """How one dimension is loaded. ``tracked`` makes it type 2, else it is type 1.

    ``referred_by`` is the column facts refer to; it gets a member for facts that resolve to none.
    """

    name: str
    key: str
    surrogate: str | None = None
    tracked: tuple[str, ...] | None = None
    referred_by: str | None = None


GOLD_DIMENSIONS = (
    DimensionSpec("dim_courier", "courier_id", "courier_key", tuple(COURIER_TRACKED), "courier_key"),
    DimensionSpec("dim_pizzeria", "pizzeria_id", "pizzeria_key", referred_by="pizzeria_key"),
    DimensionSpec("dim_customer", "customer_id", "customer_key", referred_by="customer_key"),
    DimensionSpec("dim_delivery_zone", "zone_key", referred_by="zone_key"),
    DimensionSpec("dim_order_status", "status_key", referred_by="status_key"),
    DimensionSpec("dim_date", "date_key", referred_by="date_key"),
)


def load_dimension(spec: DimensionSpec, table: VersionedTable, staged: DataFrame, as_of=None) -> int:
    """Merge staged rows into the newest version of a dimension and write the next one."""
    typed = enforce_types(staged, schemas.GOLD_TYPES.get(spec.name, {}))
    base = table.newest()
    target = table.at(base)
    if target is None:
        # An empty target with the staged columns, so that the first load is a merge like any other.
        target = typed.where(F.lit(False))
        if spec.surrogate is not None:
            target = target.withColumn(spec.surrogate, F.lit(None).cast("long"))
        if spec.tracked is not None:
            target = target.withColumn(SEEN_AT, F.array().cast("array<timestamp>"))
        if spec.referred_by is not None:
            target = dims.with_unknown_member(target, spec.referred_by)
    if spec.tracked is not None:
        merged = scd2_merge(target, typed, spec.key, list(spec.tracked), as_of, spec.surrogate)
    else:
        merged = scd1_merge(target, typed, spec.key, spec.surrogate)
    return table.write(merged, base=base)  # refuses to overwrite what another load has merged meanwhile


def load_gold_dimensions(
    spark: SparkSession, gold: str, staged: dict[str, DataFrame], as_of=None, specs=GOLD_DIMENSIONS
) -> dict[str, int]:
    """Load every staged dimension; one that fails does not keep the others from loading, but the
    run then ends with an error."""
    written, failures = {}, {}
    for spec in specs:
        if spec.name not in staged:
            continue
        try:
            written[spec.name] = load_dimension(spec, VersionedTable(spark, f"{gold}/{spec.name}"), staged[spec.name], as_of)
        except Exception as error:  # collected and raised below
            failures[spec.name] = error
    if failures:
        raise RuntimeError(f"dimension loads failed: {failures}") from next(iter(failures.values()))
    return written


CALENDAR = ("2025-01-01", "2027-12-31")


def calendar_dates(spark: SparkSession, lake: str, calendar: tuple[str, str] = CALENDAR) -> DataFrame:
    """The dates of ``calendar``, and on to those of the earliest and latest order so far, found in the partition names."""
    first, last = (F.lit(d).cast("date") for d in calendar)
    path = f"{lake}/silver/orders"
    if not path_exists(spark, path):
        return dims.date_range(spark, *calendar)
    orders = spark.read.parquet(path).agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    return dims.date_spine(orders, F.least(first, "first"), F.greatest(last, "last"))


def silver_dimensions(spark: SparkSession, lake: str, as_of=None, calendar: tuple[str, str] = CALENDAR) -> dict[str, DataFrame]:
    """The six dimensions from the three dimension files and the literal tables."""
    bronze = f"{lake}/bronze"
    return {
        "dim_courier": dims.shape_couriers(read_csv(spark, f"{bronze}/couriers", schemas.COURIER_FILE), as_of),
        "dim_pizzeria": dims.shape_pizzerias(read_csv(spark, f"{bronze}/pizzerias", schemas.PIZZERIA_FILE)),
        "dim_customer": dims.shape_customers(read_csv(spark, f"{bronze}/customers", schemas.CUSTOMER_FILE)),
        "dim_delivery_zone": dims.delivery_zones(spark),
        "dim_order_status": dims.order_statuses(spark),
        "dim_date": dims.date_attributes(calendar_dates(spark, lake, calendar)),
    }


def run_daily(
    spark: SparkSession, lake: str, process_date: str, as_of=None, max_files: int = 10_000,
    max_rows: int = MAX_ROWS_PER_FILE, calendar: tuple[str, str] = CALENDAR,
) -> None:
    """One day's batch work below ``lake``: bronze -> silver -> gold, compaction last.

    What the steps pin in the shared folder is dropped at the end of the run.
    """
    bronze, silver, gold, state = (f"{lake}/{part}" for part in ("bronze", "silver", "gold", "checkpoints"))
    with scratch_scope(spark):
        for name, drain in (("orders", silver_orders), ("telemetry", silver_telemetry)):
            if path_exists(spark, f"{bronze}/{name}"):
                drain(
                    spark, f"{bronze}/{name}", f"{silver}/{name}", f"{state}/{name}", max_files, as_of=as_of, max_rows=max_rows
                ).awaitTermination()
        staged = {}
        for name, df in silver_dimensions(spark, lake, as_of, calendar).items():
            df.write.mode("overwrite").parquet(f"{silver}/dimension/{name}")
            staged[name] = spark.read.parquet(f"{silver}/dimension/{name}")
        load_gold_dimensions(spark, gold, staged, as_of)
        daily_figures(spark, lake, process_date, as_of)
        compact_silver(spark, lake, max_rows)


SILVER_PARTITIONS = {"orders": "order_date", "telemetry": "event_date"}


def silver_table(spark: SparkSession, lake: str, name: str) -> CompactedTable:
    path = f"{lake}/silver/{name}"
    return CompactedTable(spark, path, f"{path}_compacted", SILVER_PARTITIONS[name])


def daily_figures(spark: SparkSession, lake: str, process_date: str, as_of=None) -> None:
    """Key figures of one date, replacing what was stored for it; no orders, no change.

    Compacted files are read where there are any, and small files only where they are not compacted yet.
    """
    day = silver_table(spark, lake, "orders").read(F.col("order_date") == F.lit(process_date).cast("date"))
    replace_partitions(daily_kpi(day, as_of), f"{lake}/gold/daily_sales_fact", "order_date")


def compact_silver(spark: SparkSession, lake: str, max_rows: int = MAX_ROWS_PER_FILE) -> None:
    for name in SILVER_PARTITIONS:
        silver_table(spark, lake, name).compact(max_rows)
