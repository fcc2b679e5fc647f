"""Feed snapshots built from the driver's tables, then read back through the
feed source and flattened — the collectors' data path end to end.

* vehicle snapshots <- events: one entity per event, one snapshot per UTC day
  of ts. Every field has a value of its own; fields that count on the event
  number are unset for view events, and enum numbers run past the last name.
* trip-update snapshots <- lineitem ⋈ orders: one entity per (order, ship
  day) holding its lines as stop-time updates (arrival absent for returned
  lines, departure absent for finished ones, the stop relationship unset from
  the sixth line on), one snapshot per ship day.

Entity and stop lists are nested with bounded arrays (see ``nest_bounded``),
written as JSON lines to the shared scratch space and read back with the
declared feed schema — no inference.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.functions.scalars import bucket_start, epoch_seconds
from railyard.operators.flatten import flatten_trip_updates, flatten_vehicles
from railyard.plans.standins import DAY, nest_bounded, table
from railyard.plans.transit_standins import as_epoch_micros
from railyard.schemas import FEED
from railyard.session import scratch_path
from railyard.sources.canonical import to_canonical
from railyard.sources.raw import read_feed

INGESTED_AT_MICROS = 1_700_000_000_000_000


def _snapshots(entities: DataFrame, snapshot_col: str, path: str, finish: Callable[[Column], Column] | None = None) -> str:
    """Nest entities per snapshot time, write one JSON snapshot per line; ``finish`` makes the entity of ``e``."""
    nested = nest_bounded(entities, [snapshot_col], "entity", F.col("e"), finish=finish)
    header = F.struct(F.lit("2.0").alias("gtfs_realtime_version"),
                      F.pmod(F.floor(F.col(snapshot_col) / DAY), F.lit(2)).cast("int").alias("incrementality"),
                      F.col(snapshot_col).alias("timestamp"))
    nested.select(header.alias("header"), "entity").write.option("compression", "gzip").json(path)
    return path


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def vehicle_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_feed(spark, write_vehicle_snapshots(spark, sf_dir))


def write_vehicle_snapshots(spark: SparkSession, sf_dir: str) -> str:
    """Write the vehicle snapshots built from ``events``; returns the folder."""
    ev = table(spark, sf_dir, "events")
    nr = F.when(F.col("event_type") != "view", F.col("event_id"))  # else unset
    e = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.struct(
            F.struct(F.concat(F.lit("t"), "user_id").alias("trip_id"), F.concat(F.lit("r"), "event_type").alias("route_id"),
                     (nr % 2).alias("direction_id"), F.date_format("ts", "HH:mm:ss").alias("start_time"),
                     F.date_format("ts", "yyyyMMdd").alias("start_date"), _k().alias("schedule_relationship")).alias("trip"),
            F.struct(F.concat(F.lit("v"), "user_id").alias("id"), F.col("event_type").alias("label"),
                     F.concat(F.lit("P"), nr).alias("license_plate"),
                     (nr % 5).cast("int").alias("wheelchair_accessible")).alias("vehicle"),
            F.struct(F.col("value").cast("float").alias("latitude"),
                     (-F.col("value") / 2).cast("float").alias("longitude"),
                     (nr % 360).cast("float").alias("bearing"),
                     (F.col("value") * 10 + F.col("event_id")).alias("odometer"),
                     (F.col("value") / 4).cast("float").alias("speed")).alias("position"),
            F.col("event_id").alias("current_stop_sequence"),
            _k().cast("string").alias("stop_id"),
            (nr % 4).cast("int").alias("current_status"),
            epoch_seconds("ts").alias("timestamp"),
            (nr % 6).cast("int").alias("congestion_level"),
            (nr % 10).cast("int").alias("occupancy_status"),
            (nr % 101).alias("occupancy_percentage"),
        ).alias("vehicle"),
    )
    entities = ev.select(bucket_start(epoch_seconds("ts"), DAY).alias("snap"), e.alias("e"))
    return _snapshots(entities, "snap", scratch_path(spark, "feed-vehicles"))


def trip_update_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_orderpriority")
    j = li.join(o, "l_orderkey").withColumn("snap", epoch_seconds("l_shipdate")) \
        .withColumn("mins", F.datediff("l_shipdate", "o_orderdate") * 60)
    # what is collected holds the values only; the feed's fields are made of them afterwards
    line = F.struct(F.col("l_linenumber").alias("nr"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"),
                    F.col("l_quantity").cast("int").alias("quantity"), F.col("mins"),
                    (F.col("l_returnflag") != "R").alias("arrives"), (F.col("l_linestatus") != "F").alias("departs"))
    trips = nest_bounded(j, ["l_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "snap"], "lines", line)
    entities = trips.select("snap", F.struct("l_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "lines").alias("e"))
    path = scratch_path(spark, "feed-trip-updates")
    return read_feed(spark, _snapshots(entities, "snap", path, lambda e: _trip_entity(e, F.col("snap"))))


def _stop(line: Column, snap: Column) -> Column:
    nr, mins = line["nr"], line["mins"]
    return F.struct(
        nr.cast("long").alias("stop_sequence"),
        line["part"].cast("string").alias("stop_id"),
        F.when(nr < 6, nr).alias("schedule_relationship"),
        F.when(line["arrives"], F.struct(
            mins.alias("delay"), (snap + mins).alias("time"), line["supp"].cast("int").alias("uncertainty"))).alias("arrival"),
        F.when(line["departs"], F.struct(
            (mins + 30).alias("delay"), (snap + mins + 1800).alias("time"),
            line["quantity"].alias("uncertainty"))).alias("departure"),
    )


def _trip_entity(e: Column, snap: Column) -> Column:
    order, customer = e["l_orderkey"], e["o_custkey"]
    return F.struct(
        order.cast("string").alias("id"),
        F.struct(
            F.struct(F.concat(F.lit("t"), order).alias("trip_id"), F.concat(F.lit("r"), customer).alias("route_id"),
                     (order % 2).alias("direction_id"),
                     F.concat(F.lpad((order % 24).cast("string"), 2, "0"), F.lit(":00:00")).alias("start_time"),
                     F.date_format(e["o_orderdate"], "yyyyMMdd").alias("start_date"),
                     (order % 10).cast("int").alias("schedule_relationship")).alias("trip"),
            F.struct(F.concat(F.lit("v"), customer).alias("id"), e["o_orderpriority"].alias("label")).alias("vehicle"),
            (order % 1000).cast("int").alias("delay"),
            (snap + 5).alias("timestamp"),
            F.transform(e["lines"], lambda line: _stop(line, snap)).alias("stop_time_update"),
        ).alias("trip_update"),
    )


def q_feed_vehicles(spark, sf_dir):
    stamp = F.timestamp_micros(F.lit(INGESTED_AT_MICROS))
    return as_epoch_micros(flatten_vehicles(vehicle_feed(spark, sf_dir), ingested_at=stamp))


def q_feed_trip_updates(spark, sf_dir):
    stamp = F.timestamp_micros(F.lit(INGESTED_AT_MICROS))
    return as_epoch_micros(flatten_trip_updates(trip_update_feed(spark, sf_dir), ingested_at=stamp))


def q_feed_vehicles_canonical(spark, sf_dir):
    """The same snapshots in the form that protobuf tools print, read and flattened."""
    path = scratch_path(spark, "feed-vehicles-canonical")
    to_canonical(vehicle_feed(spark, sf_dir), FEED).write.json(path)
    stamp = F.timestamp_micros(F.lit(INGESTED_AT_MICROS))
    return as_epoch_micros(flatten_vehicles(read_feed(spark, path, canonical=True), ingested_at=stamp))
