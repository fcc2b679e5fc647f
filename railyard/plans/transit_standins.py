"""The transit tables themselves (raw facts + reference tables), derived by
Spark from the driver's tables, pushed through the real silver and gold plans.

Derivation (every row of the source tables is used, and every column has a
value of its own, so that two columns taken for each other change a result):

* raw_vehicle_positions <- events: entity = user, snapshot = UTC day of ts,
  stop = ``k`` of props, arrival stamp = ts; trip, route and stop keys are
  spread wider than the reference tables, so some miss.
* raw_trip_updates <- lineitem ⋈ orders, polled ``copies`` times, a minute and
  a second of delay apart: entity = trip = order, stop = part, delays =
  ship-day difference in minutes (arrival absent for returned lines,
  departure absent for finished ones); snapshot = one of the last 28 event
  days, by the ship day.
* routes <- customer, stops <- part, trips <- orders, agency <- region,
  calendar <- supplier, calendar_dates <- orders.

Timestamps are returned as epoch microseconds so results do not depend on a
session time zone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from railyard.functions import enums as E
from railyard.functions.enums import enum_name
from railyard.functions.scalars import bucket_start, epoch_micros_ntz, epoch_seconds
from railyard.plans.changed import refresh_changed
from railyard.plans.gold import gold_current_vehicle_positions
from railyard.plans.refresh import RefreshConfig, refresh
from railyard.plans.silver import silver_trip_updates, silver_vehicle_positions
from railyard.plans.standins import DAY, table
from railyard.operators.latest import TRIP_UPDATE_KEYS, dedup_trip_updates
from railyard.operators.slices import in_slices
from railyard.schemas import (
    AGENCY,
    CALENDAR,
    CALENDAR_DATES,
    RAW_TRIP_UPDATES,
    RAW_VEHICLE_POSITIONS,
    ROUTES,
    STOPS,
    TRIPS,
)
from railyard.session import freed_shuffles, scratch_path
from railyard.sources.raw import read_raw
from railyard.sources.reference import current_delivery, load_reference_set, unparsed_rows
from railyard.sources.sinks import append_raw, conform, create_raw_tables, materialize, table_location

GOLD_FRESHNESS = 7 * DAY


def _s(col: str):
    return F.col(col).cast("string")


def _enum(number: Column, enum: E.Enum) -> Column:
    return enum_name(number.cast("int"), enum)


def raw_positions_from_events(events: DataFrame) -> DataFrame:
    secs, user, nr = epoch_seconds("ts"), F.col("user_id"), F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    return conform(events.select(
        F.concat(F.lit("e"), "user_id").alias("entity_id"),
        bucket_start(secs, DAY).alias("feed_timestamp"),
        F.lit("2.0").alias("gtfs_realtime_version"),
        _enum(nr % 2, E.INCREMENTALITY).alias("incrementality"),
        (user * 150).cast("string").alias("trip_id"),
        (user * 12 + 1).cast("string").alias("route_id"),
        (user % 2).alias("direction_id"),
        F.date_format("ts", "HH:mm:ss").alias("start_time"),
        F.date_format("ts", "yyyyMMdd").alias("start_date"),
        _enum(k % 9, E.TRIP_SCHEDULE_RELATIONSHIP).alias("schedule_relationship"),
        F.concat(F.lit("v"), user % 97).alias("vehicle_id"),
        F.col("event_type").alias("vehicle_label"),
        F.concat(F.lit("P"), "event_id").alias("license_plate"),
        _enum(user % 4, E.WHEELCHAIR_ACCESSIBLE).alias("wheelchair_accessible"),
        F.col("value").cast("float").alias("latitude"),
        (-F.col("value") / 2).cast("float").alias("longitude"),
        (nr % 360).cast("float").alias("bearing"),
        (F.col("value") * 10 + nr).alias("odometer"),
        F.when(F.col("event_type") != "error", (F.col("value") / 4).cast("float")).alias("speed"),
        (nr % 40).alias("current_stop_sequence"),
        (k * 25).cast("string").alias("stop_id"),
        _enum(nr % 3, E.VEHICLE_STOP_STATUS).alias("current_status"),
        secs.alias("vehicle_timestamp"),
        _enum(nr % 5, E.CONGESTION_LEVEL).alias("congestion_level"),
        _enum(nr % 9, E.OCCUPANCY_STATUS).alias("occupancy_status"),
        (nr % 101).alias("occupancy_percentage"),
        F.timestamp_micros(epoch_micros_ntz("ts")).alias("ingested_at"),
    ), RAW_VEHICLE_POSITIONS)


SNAPSHOT_DAYS = 28
# raw rows that one task derives and ranks: few enough to sort in memory, copies included
ROWS_PER_TASK = 500_000


def _tasks(lineitem: DataFrame, copies: int) -> int:
    return max(_files(lineitem.sparkSession), -(-lineitem.count() * copies // ROWS_PER_TASK))


def raw_trip_updates_from_lines(lineitem: DataFrame, orders: DataFrame, events: DataFrame, copies: int = 2) -> DataFrame:
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_orderpriority")
    newest = events.select(bucket_start(epoch_seconds(F.max("ts")), DAY)).scalar()
    last_ship = lineitem.select(F.max("l_shipdate")).scalar()
    behind = F.pmod(F.datediff(last_ship, "l_shipdate"), F.lit(SNAPSHOT_DAYS))
    # a partition's rows are multiplied by the copies after the join: their number follows the rows that come out, as
    # partitions merged by the size of what goes in would be sorted on disk
    tasks = _tasks(lineitem, copies)
    lines, o = lineitem.repartition(tasks, "l_orderkey"), o.repartition(tasks, "l_orderkey")
    # computed once per row, then reused (the scalar subqueries run once)
    j = (lines.join(o, "l_orderkey").withColumn("__fts", newest - behind * DAY)
         .withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))))
    feed_ts, copy, order, nr = F.col("__fts"), F.col("__copy"), F.col("l_orderkey"), F.col("l_linenumber")
    minutes = F.datediff("l_shipdate", "o_orderdate") * 60
    return conform(j.select(
        F.concat(F.lit("t"), order).alias("entity_id"),
        feed_ts.alias("feed_timestamp"),
        F.lit("2.0").alias("gtfs_realtime_version"),
        _enum(nr % 2, E.INCREMENTALITY).alias("incrementality"),
        _s("l_orderkey").alias("trip_id"),
        (F.col("o_custkey") + 100).cast("string").alias("route_id"),
        (order % 2).alias("direction_id"),
        F.concat(F.lpad((order % 24).cast("string"), 2, "0"), F.lit(":00:00")).alias("start_time"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("start_date"),
        _enum(order % 9, E.TRIP_SCHEDULE_RELATIONSHIP).alias("schedule_relationship"),
        F.concat(F.lit("v"), F.col("o_custkey") % 97).alias("vehicle_id"),
        F.col("o_orderpriority").alias("vehicle_label"),
        (minutes + copy).alias("trip_delay"),
        (feed_ts + nr).alias("trip_timestamp"),
        nr.alias("stop_sequence"),
        (F.col("l_partkey") + 50).cast("string").alias("stop_id"),
        F.when(F.col("l_returnflag") != "R", minutes + 2 * copy).alias("arrival_delay"),
        (feed_ts + minutes).alias("arrival_time"),
        F.col("l_suppkey").alias("arrival_uncertainty"),
        F.when(F.col("l_linestatus") != "F", minutes + 30 + 3 * copy).alias("departure_delay"),
        (feed_ts + minutes + 1800).alias("departure_time"),
        F.col("l_quantity").cast("int").alias("departure_uncertainty"),
        _enum(nr % 4, E.STOP_SCHEDULE_RELATIONSHIP).alias("stop_schedule_relationship"),
        F.timestamp_micros((feed_ts + 60 * copy) * 1_000_000 + (F.col("l_quantity") * 1_000_000).cast("bigint"))
        .alias("ingested_at"),
    ), RAW_TRIP_UPDATES)


def _t(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), column)


def routes_from_customer(customer: DataFrame) -> DataFrame:
    return conform(customer.select(
        _s("c_custkey").alias("route_id"), _s("c_nationkey").alias("agency_id"),
        F.col("c_mktsegment").alias("route_short_name"), F.col("c_name").alias("route_long_name"),
        _t("desc ", "c_nationkey").alias("route_desc"), (F.col("c_nationkey") % 8).alias("route_type"),
        _t("http://routes/", "c_custkey").alias("route_url"), _t("c", "c_custkey").alias("route_color"),
        _t("t", "c_custkey").alias("route_text_color"),
    ), ROUTES)


def stops_from_part(part: DataFrame) -> DataFrame:
    return conform(part.select(
        _s("p_partkey").alias("stop_id"), _t("code ", "p_partkey").alias("stop_code"),
        F.col("p_name").alias("stop_name"), F.col("p_type").alias("stop_desc"),
        F.col("p_retailprice").alias("stop_lat"), (-F.col("p_size")).cast("double").alias("stop_lon"),
        F.col("p_brand").alias("zone_id"), _t("http://stops/", "p_partkey").alias("stop_url"),
        (F.col("p_partkey") % 3).alias("location_type"), _t("parent ", "p_size").alias("parent_station"),
        (F.col("p_partkey") % 10).cast("string").alias("platform_code"),
    ), STOPS)


def trips_from_orders(orders: DataFrame) -> DataFrame:
    return conform(orders.select(
        _s("o_custkey").alias("route_id"), F.col("o_orderstatus").alias("service_id"),
        _s("o_orderkey").alias("trip_id"), F.col("o_orderpriority").alias("trip_headsign"),
        _t("short ", "o_orderkey").alias("trip_short_name"), (F.col("o_orderkey") % 2).alias("direction_id"),
        _t("block ", "o_custkey").alias("block_id"), _t("shape ", "o_orderkey").alias("shape_id"),
        (F.col("o_orderkey") % 3).alias("wheelchair_accessible"),
    ), TRIPS)


def agency_from_region(region: DataFrame) -> DataFrame:
    return conform(region.select(
        _s("r_regionkey").alias("agency_id"), F.col("r_name").alias("agency_name"),
        _t("http://agency/", "r_regionkey").alias("agency_url"), F.lit("UTC").alias("agency_timezone"),
        _t("lang ", "r_regionkey").alias("agency_lang"), _t("+1", "r_regionkey").alias("agency_phone"),
    ), AGENCY)


WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def calendar_from_supplier(supplier: DataFrame) -> DataFrame:
    days = [F.getbit("s_suppkey", F.lit(i)).cast("int").alias(day) for i, day in enumerate(WEEKDAYS)]
    return conform(supplier.select(
        _s("s_suppkey").alias("service_id"), *days,
        (F.col("s_nationkey") + 20240101).cast("string").alias("start_date"),
        (F.col("s_nationkey") + 20250101).cast("string").alias("end_date"),
    ), CALENDAR)


def calendar_dates_from_orders(orders: DataFrame) -> DataFrame:
    return conform(orders.select(
        _s("o_orderkey").alias("service_id"), F.date_format("o_orderdate", "yyyyMMdd").alias("date"),
        (1 + F.col("o_orderkey") % 2).alias("exception_type"),
    ), CALENDAR_DATES)


def _inputs(spark: SparkSession, sf_dir: str):
    t = lambda n: table(spark, sf_dir, n)
    events = t("events")
    return dict(
        raw_vp=raw_positions_from_events(events),
        raw_tu=raw_trip_updates_from_lines(t("lineitem"), t("orders"), events),
        routes=routes_from_customer(t("customer")),
        stops=stops_from_part(t("part")),
        trips=trips_from_orders(t("orders")),
    )


def as_epoch_micros(df: DataFrame) -> DataFrame:
    """Timestamp columns -> epoch microseconds (zone-free comparison)."""
    return df.select(*[
        F.unix_micros(F.col(f.name)).alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _silver_vp(i):
    return silver_vehicle_positions(i["raw_vp"], i["routes"], i["stops"], i["trips"])


def _silver_tu(i):
    return silver_trip_updates(i["raw_tu"], i["routes"], i["stops"], i["trips"])


def q_transit_silver_positions(spark, sf_dir):
    return as_epoch_micros(_silver_vp(_inputs(spark, sf_dir)))


def stored_slices(spark: SparkSession, rows: DataFrame, keys: tuple[str, ...], plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``plan`` over ``rows``; if they are many, a slice of their keys after the other, stored."""
    with freed_shuffles(spark):
        parts = [plan(part) for part in in_slices(rows, keys)]
        return parts[0] if len(parts) == 1 else materialize(parts, path=scratch_path(spark, "slices"))


def q_transit_silver_trip_updates(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return as_epoch_micros(stored_slices(spark, i["raw_tu"], TRIP_UPDATE_KEYS, lambda raw: _silver_tu({**i, "raw_tu": raw})))


def q_transit_dedup_trip_updates(spark, sf_dir):
    """All 24 raw columns, five copies a row (a feed refreshed every five minutes, polled every minute)."""
    t = lambda n: table(spark, sf_dir, n)
    return as_epoch_micros(dedup_trip_updates(raw_trip_updates_from_lines(t("lineitem"), t("orders"), t("events"), copies=5)))


def q_transit_gold_current(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    as_of = i["raw_vp"].select(F.max("feed_timestamp")).scalar()
    gold = gold_current_vehicle_positions(_silver_vp(i), _silver_tu(i), as_of, GOLD_FRESHNESS)
    return as_epoch_micros(gold)


def q_transit_silver_window(spark, sf_dir):
    """Silver positions with the documented rolling window (2 days here, as
    the stand-in snapshots are a day apart) applied before de-duplication."""
    i = _inputs(spark, sf_dir)
    as_of = i["raw_vp"].select(F.max("feed_timestamp")).scalar()
    return as_epoch_micros(silver_vehicle_positions(
        i["raw_vp"], i["routes"], i["stops"], i["trips"], window_seconds=2 * DAY, as_of=as_of))


REFERENCE = {"agency": ("region", agency_from_region), "routes": ("customer", routes_from_customer),
             "stops": ("part", stops_from_part), "trips": ("orders", trips_from_orders),
             "calendar": ("supplier", calendar_from_supplier), "calendar_dates": ("orders", calendar_dates_from_orders)}


def _land(spark: SparkSession, sf_dir: str, landing: str, names=tuple(REFERENCE), **changed) -> None:
    """Write members of a reference delivery as CSV files with a header."""
    for name in names:
        source, derive = REFERENCE[name]
        df = derive(table(spark, sf_dir, source))
        df = changed[name](df) if name in changed else df
        df.write.mode("overwrite").option("header", True).csv(f"{landing}/{name}.txt")


def _files(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect sessions have no SparkContext
        return 8


def q_refresh_gold(spark, sf_dir):
    """The whole refresh over derived tables, by name: the schema and its raw tables are created, raw rows are
    appended to them through the schema-enforcing sink, all six reference members land as CSV files, ``refresh``
    publishes named tables (silver by date), and the gold table is read by its name."""
    i = _inputs(spark, sf_dir)
    root, schema = scratch_path(spark, "refresh"), f"railyard_{uuid.uuid4().hex[:12]}"
    create_raw_tables(spark, schema, f"{root}/raw")
    _land(spark, sf_dir, f"{root}/landing")
    raw_vp, raw_tu = f"{schema}.raw_vehicle_positions", f"{schema}.raw_trip_updates"
    # raw rows arrive as many appended files; copies of a key lie in several
    append_raw(i["raw_vp"].repartition(_files(spark), "license_plate"), table_location(spark, raw_vp), RAW_VEHICLE_POSITIONS)
    append_raw(i["raw_tu"], table_location(spark, raw_tu), RAW_TRIP_UPDATES)  # a file a task
    for name in (raw_vp, raw_tu):
        spark.catalog.refreshTable(name)
    as_of = read_raw(spark, raw_vp).agg(F.max("feed_timestamp")).first()[0]
    refresh(spark, RefreshConfig(landing=f"{root}/landing", raw_positions=raw_vp, raw_trip_updates=raw_tu,
                                 out=f"{root}/out", as_of=as_of, freshness_seconds=GOLD_FRESHNESS, schema=schema))
    return as_epoch_micros(spark.read.table(f"{schema}.gld_current_vehicle_positions"))


def q_refresh_changed(spark, sf_dir):
    """Silver positions after a second, change-driven refresh: one route was renamed and the rows of the newest day
    came in between. ``rebuilt`` says whether the row's day was rebuilt by it."""
    i = _inputs(spark, sf_dir)
    root = scratch_path(spark, "changed")
    newest = i["raw_vp"].agg(F.max("feed_timestamp")).first()[0]
    renamed = F.when(F.col("route_id") == "1", "old name").otherwise(F.col("route_long_name"))
    _land(spark, sf_dir, f"{root}/landing", routes=lambda df: df.withColumn("route_long_name", renamed))
    cfg = RefreshConfig(landing=f"{root}/landing", raw_positions=f"{root}/raw_vp", raw_trip_updates=f"{root}/raw_tu",
                        out=f"{root}/out", as_of=newest, freshness_seconds=GOLD_FRESHNESS)
    for part in in_slices(i["raw_tu"], TRIP_UPDATE_KEYS):
        append_raw(part, cfg.raw_trip_updates, RAW_TRIP_UPDATES, date_partitioned=True)
    first, last = F.col("feed_timestamp") < newest, F.col("feed_timestamp") >= newest
    append_raw(i["raw_vp"].where(first), cfg.raw_positions, RAW_VEHICLE_POSITIONS, date_partitioned=True)
    refresh_changed(spark, cfg)
    append_raw(i["raw_vp"].where(last), cfg.raw_positions, RAW_VEHICLE_POSITIONS, date_partitioned=True)
    _land(spark, sf_dir, f"{root}/landing", names=("routes",))
    done = refresh_changed(spark, cfg)
    days = [d * DAY for d in done.rebuilt["slv_vehicle_positions"]]  # one number a day
    out = done.tables["slv_vehicle_positions"]
    return as_epoch_micros(out.withColumn("rebuilt", F.col("feed_timestamp").isin(days)))


def q_reference_delivery(spark, sf_dir):
    """All six members after a second delivery without agency, in which routes have new names and an exception type is
    no number in every fifth line; the rows that don't parse are told from those that do."""
    root = scratch_path(spark, "delivery")
    _land(spark, sf_dir, f"{root}/one")
    load_reference_set(spark, f"{root}/one", f"{root}/reference")
    kind = F.when(F.col("service_id").cast("long") % 5 == 0, "none").when(F.col("service_id").cast("long") % 5 == 1, "") \
        .otherwise(F.col("exception_type").cast("string"))
    _land(spark, sf_dir, f"{root}/two", names=("routes", "stops", "trips", "calendar", "calendar_dates"),
          routes=lambda df: df.withColumn("route_long_name", F.upper(F.concat(F.lit("new "), "route_long_name"))),
          calendar_dates=lambda df: df.withColumn("exception_type", kind))
    ref = load_reference_set(spark, f"{root}/two", f"{root}/reference")
    shown = {
        "agency": ("agency_id", F.concat_ws("|", "agency_name", "agency_url", "agency_timezone", "agency_lang", "agency_phone"), F.lit(None)),
        "routes": ("route_id", F.concat_ws("|", "agency_id", "route_short_name", "route_long_name", "route_desc", "route_url", "route_color", "route_text_color"), F.col("route_type")),
        "stops": ("stop_id", F.concat_ws("|", "stop_code", "stop_name", "stop_desc", "zone_id", "stop_url", "parent_station", "platform_code"), F.col("location_type")),
        "trips": ("trip_id", F.concat_ws("|", "route_id", "service_id", "trip_headsign", "trip_short_name", "block_id", "shape_id"), 10 * F.col("direction_id") + F.col("wheelchair_accessible")),
        "calendar": ("service_id", F.concat_ws("|", "start_date", "end_date"), sum((F.col(d) * 2 ** i for i, d in enumerate(WEEKDAYS)), F.lit(0))),
        "calendar_dates": ("service_id", F.col("date"), F.col("exception_type")),
    }
    delivery = current_delivery(spark, f"{root}/reference")
    out = None
    for name, (key, text, number) in shown.items():
        bad = unparsed_rows(spark, f"{root}/reference", name).select(F.col(key).alias("key"), F.lit(True).alias("unparsed")).distinct()
        rows = ref[name].select(F.col(key).alias("key"), text.alias("text"), number.cast("long").alias("number")).join(bad, "key", "left")
        rows = rows.select(F.lit(name).alias("member"), F.lit(delivery.members[name].delivery).cast("long").alias("delivery"),
                           "key", "text", "number", F.coalesce("unparsed", F.lit(False)).alias("unparsed"))
        out = rows if out is None else out.unionByName(rows)
    return out
