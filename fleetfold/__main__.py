"""Jobs by name: ``python -m fleetfold <job> --lake <path>`` (or through ``spark-submit``)."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from fleetfold.functions.time import parse
from fleetfold.plans import daily
from fleetfold.plans.daily import CALENDAR
from fleetfold.schemas import ORDER_EVENT, TELEMETRY_EVENT
from fleetfold.session import tune
from fleetfold.sources.files import stream_json, wait_for_path
from fleetfold.sources.tables import MAX_ROWS_PER_FILE, BatchTable
from fleetfold.streaming import ingest, live

FILES_PER_BATCH = {"live-fleet": 100, "live-orders": 100, "order-performance": 1000, "spaced-telemetry": 100, "odometer": 100}


def _dimensions(spark: SparkSession, gold: str) -> live.GoldDimensions:
    dims = live.GoldDimensions(spark, gold)
    if dims.missing():
        raise SystemExit(f"load the gold dimensions first: {dims.missing()}")
    return dims


def _stream(spark: SparkSession, job: str, lake: str, once: bool, files: int | None, as_of_couriers: bool) -> None:
    orders = job == "live-orders"
    feed = f"{lake}/bronze/{'orders' if orders else 'telemetry'}"
    wait_for_path(spark, feed)
    source = stream_json(spark, feed, ORDER_EVENT if orders else TELEMETRY_EVENT, files or FILES_PER_BATCH[job])
    state, gold = f"{lake}/checkpoints/{job}", f"{lake}/gold"
    every = {"every": None} if once else {}
    metrics = live.metrics_table(spark, f"{gold}/{job.replace('-', '_')}_batches")
    if job == "live-fleet":
        late = live.LateEvents(spark, f"{gold}/live_fleet_late", parse("timestamp"))
        query = live.live_fleet(source, live.fleet_table(spark, f"{gold}/live_fleet_status"), state, late=late, metrics=metrics, **every)
    elif orders:
        query = live.live_orders(source, live.orders_table(spark, f"{gold}/live_orders_log"), state, metrics=metrics, **every)
    elif job == "odometer":
        typed = source.withColumn("timestamp", parse("timestamp"))
        query = live.odometer(typed, live.odometer_table(spark, f"{gold}/live_odometer"), state, metrics=metrics, **every)
    elif job == "spaced-telemetry":
        typed = source.withColumn("timestamp", parse("timestamp"))
        last = live.LastSeen(spark, f"{gold}/spaced_telemetry_last", "order_id", "timestamp", "event_id")
        query = live.spaced_events(typed, last, BatchTable(spark, f"{gold}/spaced_telemetry"), state, every=None if once else "1 second")
    else:
        facts = live.performance_table(spark, f"{gold}/fact_order_performance", live.AS_OF_PERFORMANCE if as_of_couriers else live.ORDER_PERFORMANCE)
        policies = {"policies": live.AS_OF_PERFORMANCE, "courier_at": "order_timestamp"} if as_of_couriers else {}
        query = live.order_performance(source, facts, _dimensions(spark, gold), state, metrics=metrics, **policies, **every)
    query.awaitTermination()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="fleetfold")
    jobs = ["daily", "silver-orders", "silver-telemetry", "gold-dimensions", "daily-kpi", "compact", *FILES_PER_BATCH]
    parser.add_argument("job", choices=jobs)
    parser.add_argument("--lake", required=True, help="folder with bronze/, silver/, gold/ and checkpoints/")
    parser.add_argument("--process-date", help="yyyy-MM-dd, for daily and daily-kpi")
    parser.add_argument("--once", action="store_true", help="streams: take what is there, then stop")
    parser.add_argument("--couriers-as-of-order", action="store_true", help="order-performance: the courier's version of the order's time")
    parser.add_argument("--files-per-batch", type=int, help="streams: files that one micro-batch takes")
    parser.add_argument("--max-rows-per-file", type=int, default=MAX_ROWS_PER_FILE, help="compact and drains: rows per file")
    parser.add_argument("--calendar", nargs=2, metavar=("FIRST", "LAST"), default=CALENDAR, help="dates that dim_date has at least")
    args = parser.parse_args(argv)
    if args.job in ("daily", "daily-kpi") and not args.process_date:
        parser.error(f"{args.job} needs --process-date")
    spark = tune(spark or SparkSession.builder.appName(f"fleetfold-{args.job}").getOrCreate())
    lake = args.lake.rstrip("/")
    if args.job == "daily":
        daily.run_daily(spark, lake, args.process_date, max_rows=args.max_rows_per_file, calendar=tuple(args.calendar))
    elif args.job == "silver-orders":
        ingest.silver_orders(
            spark, f"{lake}/bronze/orders", f"{lake}/silver/orders", f"{lake}/checkpoints/orders",
            args.files_per_batch or ingest.FILES_PER_DRAIN, max_rows=args.max_rows_per_file,
        ).awaitTermination()
    elif args.job == "silver-telemetry":
        ingest.silver_telemetry(
            spark, f"{lake}/bronze/telemetry", f"{lake}/silver/telemetry", f"{lake}/checkpoints/telemetry",
            args.files_per_batch or ingest.FILES_PER_DRAIN, max_rows=args.max_rows_per_file,
        ).awaitTermination()
    elif args.job == "gold-dimensions":
        daily.load_gold_dimensions(spark, f"{lake}/gold", daily.silver_dimensions(spark, lake, calendar=tuple(args.calendar)))
    elif args.job == "daily-kpi":
        daily.daily_figures(spark, lake, args.process_date)
    elif args.job == "compact":
        daily.compact_silver(spark, lake, args.max_rows_per_file)
    else:
        _stream(spark, args.job, lake, args.once, args.files_per_batch, args.couriers_as_of_order)


if __name__ == "__main__":
    main()
