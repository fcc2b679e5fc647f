"""Job entry points for ``spark-submit`` (or ``python -m railyard.jobs``).

    init     create the schema and both raw tables (idempotent)
    collect  stream feed snapshot files -> flatten -> schema-enforced raw append
    silver   keep a de-duplicated raw table from a raw table's stream, window bounded
    refresh  reference files -> silver -> gold, layer by layer; of named tables, or
             only what changed since the last one
    compact  rewrite the small batches of a table that collect --versioned fills

Cluster settings (master, executors, spark.checkpoint.dir) come from
spark-submit; the session adds only the engine's SQL settings.
"""

from __future__ import annotations

import argparse
import sys

from railyard.operators.flatten import flatten_trip_updates, flatten_vehicles
from railyard.plans.changed import refresh_changed
from railyard.plans.refresh import RefreshConfig, refresh
from railyard.schemas import RAW_TRIP_UPDATES, RAW_VEHICLE_POSITIONS
from railyard.session import build_session
from railyard.sources import versions
from railyard.sources.raw import read_feed
from railyard.sources.sinks import create_raw_tables, table_location
from railyard.streaming.append import stream_raw
from railyard.streaming.incremental import stream_silver_positions, stream_silver_trip_updates
from railyard.streaming.ledger import compact, stream_append

FEEDS = {
    "vehicle_positions": (flatten_vehicles, RAW_VEHICLE_POSITIONS),
    "trip_updates": (flatten_trip_updates, RAW_TRIP_UPDATES),
}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="railyard.jobs")
    sub = p.add_subparsers(dest="command", required=True)

    init = sub.add_parser("init", help="create the schema and the raw tables")
    init.add_argument("--schema", required=True)
    init.add_argument("--location", help="folder for the table data")

    col = sub.add_parser("collect", help="stream snapshot files into a raw table")
    col.add_argument("--feed", choices=sorted(FEEDS), required=True)
    col.add_argument("--source", required=True, help="folder (or glob) of JSON snapshot files")
    col.add_argument("--raw", required=True, help="raw table: its folder, or its name (schema.table)")
    col.add_argument("--canonical", action="store_true", help="snapshots as protobuf tools print them")
    col.add_argument("--versioned", action="store_true", help="append by published versions, with ledger and compaction")
    col.add_argument("--checkpoint", required=True)
    col.add_argument("--continuous", action="store_true", help="keep running (default: drain and stop)")
    col.add_argument("--interval", default="1 minute")
    col.add_argument("--date-partitioned", action="store_true")
    col.add_argument("--max-files-per-trigger", type=int,
                     help="bound each micro-batch (catching up after downtime)")

    sil = sub.add_parser("silver", help="keep a de-duplicated raw table up to date")
    sil.add_argument("--feed", choices=sorted(FEEDS), required=True)
    sil.add_argument("--raw", required=True, help="raw table: its folder, or its name")
    sil.add_argument("--target", required=True, help="folder of the de-duplicated table")
    sil.add_argument("--checkpoint", required=True)
    sil.add_argument("--bucket-seconds", type=int, default=3600)
    sil.add_argument("--retain-seconds", type=int, help="keep this much event time only (e.g. 7200)")
    sil.add_argument("--continuous", action="store_true")
    sil.add_argument("--interval", default="5 minutes")
    sil.add_argument("--max-files-per-trigger", type=int)

    com = sub.add_parser("compact", help="rewrite small batches (while no collect runs)")
    com.add_argument("--raw", required=True)

    ref = sub.add_parser("refresh", help="reference -> silver -> gold")
    ref.add_argument("--landing", required=True)
    ref.add_argument("--raw-positions", required=True)
    ref.add_argument("--raw-trip-updates", required=True)
    ref.add_argument("--out", required=True)
    ref.add_argument("--window-seconds", type=int, help="rolling window before dedup (e.g. 7200)")
    ref.add_argument("--as-of", type=int, help="reference time, POSIX seconds (default: now)")
    ref.add_argument("--freshness-seconds", type=int, default=900)
    ref.add_argument("--shuffle-partitions", type=int)
    ref.add_argument("--unpartitioned-silver", action="store_true")
    ref.add_argument("--schema", help="publish named, commented tables of this schema")
    ref.add_argument("--changed", action="store_true", help="rebuild only the days that changed input touches")
    ref.add_argument("--unique-keys", action="store_true", help="fail if a reference table repeats a key")
    ref.add_argument("--max-unparsed", type=int, help="refuse a delivery with more rows that don't parse")
    return p


def _folder(spark, table_or_path: str) -> str:
    return table_or_path if "/" in table_or_path or ":" in table_or_path else table_location(spark, table_or_path)


def main(argv: list[str] | None = None, master: str | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(master, app=f"railyard-{args.command}")
    if args.command == "init":
        create_raw_tables(spark, args.schema, args.location).show(truncate=False)
    elif args.command == "collect":
        flatten, schema = FEEDS[args.feed]
        source = read_feed(spark, args.source, streaming=True, max_files_per_trigger=args.max_files_per_trigger,
                           canonical=args.canonical)
        raw, how = _folder(spark, args.raw), dict(transform=flatten, schema=schema, available_now=not args.continuous,
                                                  processing_time=args.interval)
        if args.versioned:
            query = stream_append(source, raw, args.checkpoint, event_time="feed_timestamp", **how)
        else:
            query = stream_raw(source, raw, args.checkpoint, date_partitioned=args.date_partitioned, **how)
        query.awaitTermination()
    elif args.command == "silver":
        keep = {"vehicle_positions": stream_silver_positions, "trip_updates": stream_silver_trip_updates}[args.feed]
        reader = spark.readStream.schema(FEEDS[args.feed][1])
        if args.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", args.max_files_per_trigger)
        keep(reader.parquet(_folder(spark, args.raw)), args.target, args.checkpoint, bucket_seconds=args.bucket_seconds,
             retain_seconds=args.retain_seconds, available_now=not args.continuous,
             processing_time=args.interval).awaitTermination()
    elif args.command == "compact":
        compact(spark, args.raw)
        versions.vacuum(spark, args.raw)
    else:
        cfg = RefreshConfig(
            landing=args.landing, raw_positions=args.raw_positions, raw_trip_updates=args.raw_trip_updates,
            out=args.out, window_seconds=args.window_seconds, as_of=args.as_of,
            freshness_seconds=args.freshness_seconds, shuffle_partitions=args.shuffle_partitions,
            partition_silver_by_date=not args.unpartitioned_silver, schema=args.schema,
            unique_keys=args.unique_keys, max_unparsed=args.max_unparsed)
        if args.changed and args.schema:
            raise SystemExit("--changed keeps its tables as folders of versions; it can't be combined with --schema")
        out = refresh_changed(spark, cfg).tables if args.changed else refresh(spark, cfg)
        for name, df in out.items():
            print(name, df.count())
    return 0


if __name__ == "__main__":
    sys.exit(main())
