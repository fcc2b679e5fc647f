"""Nested feed snapshot -> flat raw rows (header and parent fields repeated).

A snapshot is one row ``struct<header, entity: array<struct>>``; flattening
is ``explode`` (inner: an empty or missing child list yields no row) plus
field access, so it is a narrow, per-row transformation: no shuffle, and
each task handles whole snapshots of bounded size.

Unset fields read as their defaults, as a protobuf reader would: ``""`` for
strings, ``0`` for numbers, the declared default for enums
(``fill_defaults=True``, parity). ``zero_fill=False`` keeps an absent
arrival/departure as NULL so the departure delay and the UNKNOWN category
become reachable downstream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType, StructType

from railyard.functions import enums as E
from railyard.functions.enums import enum_name
from railyard.schemas import RAW_TRIP_UPDATES, RAW_VEHICLE_POSITIONS


def has(col: Column | str) -> Column:
    """Presence of an optional sub-message."""
    return (F.col(col) if isinstance(col, str) else col).isNotNull()


def unnest(df: DataFrame, array_col: str, alias: str, keep: Sequence[str | Column],
           position: str | None = None, outer: bool = False) -> DataFrame:
    """One row per element of ``array_col`` with ``keep`` repeated.
    Inner by default: NULL or empty arrays produce no row."""
    if position:
        fn = F.posexplode_outer if outer else F.posexplode
        return df.select(*keep, fn(array_col).alias(position, alias))
    fn = F.explode_outer if outer else F.explode
    return df.select(*keep, fn(array_col).alias(alias))


def type_default(dtype: DataType) -> Column | None:
    if isinstance(dtype, StringType):
        return F.lit("")
    if isinstance(dtype, NumericType):
        return F.lit(0).cast(dtype)
    return None


def zero_fill(col: Column | str, enabled: bool = True, value=0) -> Column:
    """``coalesce(col, value)`` when enabled (absent message reads as zero)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(value)) if enabled else c


def fill_defaults(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Replace NULL with the type default in every string / numeric column."""
    schema = schema or df.schema
    cols = []
    for field in schema.fields:
        d = type_default(field.dataType)
        c = F.col(field.name)
        cols.append((F.coalesce(c, d) if d is not None else c).alias(field.name))
    return df.select(*cols)


def stamp_ingested(df: DataFrame, at_micros: int | None = None, column: str = "ingested_at") -> DataFrame:
    """Arrival stamp: one value for the whole batch (``current_timestamp()`` is
    evaluated once per query) or a fixed epoch-microsecond value."""
    stamp = F.current_timestamp() if at_micros is None else F.timestamp_micros(F.lit(at_micros))
    return df.withColumn(column, stamp)


def _finish(df: DataFrame, schema: StructType, fill: bool) -> DataFrame:
    """Cast to the table types (uint32 -> int narrowing) and apply defaults."""
    cols = []
    for field in schema.fields:
        c = F.col(field.name).cast(field.dataType)
        d = type_default(field.dataType) if fill else None
        cols.append((F.coalesce(c, d) if d is not None else c).alias(field.name))
    return df.select(*cols)


def _header_cols(fill: bool) -> list[Column]:
    return [
        F.col("e.id").alias("entity_id"),
        F.col("h.timestamp").alias("feed_timestamp"),
        F.col("h.gtfs_realtime_version").alias("gtfs_realtime_version"),
        enum_name("h.incrementality", E.INCREMENTALITY, fill).alias("incrementality"),
    ]


def _trip_cols(trip: str, fill: bool) -> list[Column]:
    return [
        F.col(f"{trip}.trip_id").alias("trip_id"),
        F.col(f"{trip}.route_id").alias("route_id"),
        F.col(f"{trip}.direction_id").alias("direction_id"),
        F.col(f"{trip}.start_time").alias("start_time"),
        F.col(f"{trip}.start_date").alias("start_date"),
        enum_name(f"{trip}.schedule_relationship", E.TRIP_SCHEDULE_RELATIONSHIP, fill)
        .alias("schedule_relationship"),
    ]


def flatten_vehicles(feed: DataFrame, fill_defaults: bool = True,
                     ingested_at: Column | None = None) -> DataFrame:
    """One raw_vehicle_positions row (27 columns) per entity holding a vehicle."""
    v = "e.vehicle"
    rows = (feed.select(F.col("header").alias("h"), F.explode("entity").alias("e"))
            .filter(has(v)))
    flat = rows.select(
        *_header_cols(fill_defaults),
        *_trip_cols(f"{v}.trip", fill_defaults),
        F.col(f"{v}.vehicle.id").alias("vehicle_id"),
        F.col(f"{v}.vehicle.label").alias("vehicle_label"),
        F.col(f"{v}.vehicle.license_plate").alias("license_plate"),
        enum_name(f"{v}.vehicle.wheelchair_accessible", E.WHEELCHAIR_ACCESSIBLE, fill_defaults)
        .alias("wheelchair_accessible"),
        F.col(f"{v}.position.latitude").alias("latitude"),
        F.col(f"{v}.position.longitude").alias("longitude"),
        F.col(f"{v}.position.bearing").alias("bearing"),
        F.col(f"{v}.position.odometer").alias("odometer"),
        F.col(f"{v}.position.speed").alias("speed"),
        F.col(f"{v}.current_stop_sequence").alias("current_stop_sequence"),
        F.col(f"{v}.stop_id").alias("stop_id"),
        enum_name(f"{v}.current_status", E.VEHICLE_STOP_STATUS, fill_defaults).alias("current_status"),
        F.col(f"{v}.timestamp").alias("vehicle_timestamp"),
        enum_name(f"{v}.congestion_level", E.CONGESTION_LEVEL, fill_defaults).alias("congestion_level"),
        enum_name(f"{v}.occupancy_status", E.OCCUPANCY_STATUS, fill_defaults).alias("occupancy_status"),
        F.col(f"{v}.occupancy_percentage").alias("occupancy_percentage"),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("ingested_at"),
    )
    return _finish(flat, RAW_VEHICLE_POSITIONS, fill_defaults)


def flatten_trip_updates(feed: DataFrame, zero_fill_events: bool = True, fill_defaults: bool = True,
                         ingested_at: Column | None = None) -> DataFrame:
    """One raw_trip_updates row (24 columns) per stop-time update; trip-level
    fields repeated on each; trip updates without stop updates yield nothing."""
    t = "e.trip_update"
    trips = (feed.select(F.col("header").alias("h"), F.explode("entity").alias("e"))
             .filter(has(t)))
    stops = unnest(trips, f"{t}.stop_time_update", "s", keep=["h", "e"])

    def event(kind: str, field: str) -> Column:
        return zero_fill(F.col(f"s.{kind}.{field}"), zero_fill_events).alias(f"{kind}_{field}")

    flat = stops.select(
        *_header_cols(fill_defaults),
        *_trip_cols(f"{t}.trip", fill_defaults),
        F.col(f"{t}.vehicle.id").alias("vehicle_id"),
        F.col(f"{t}.vehicle.label").alias("vehicle_label"),
        F.col(f"{t}.delay").alias("trip_delay"),
        F.col(f"{t}.timestamp").alias("trip_timestamp"),
        F.col("s.stop_sequence").alias("stop_sequence"),
        F.col("s.stop_id").alias("stop_id"),
        event("arrival", "delay"), event("arrival", "time"), event("arrival", "uncertainty"),
        event("departure", "delay"), event("departure", "time"), event("departure", "uncertainty"),
        enum_name("s.schedule_relationship", E.STOP_SCHEDULE_RELATIONSHIP, fill_defaults)
        .alias("stop_schedule_relationship"),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("ingested_at"),
    )
    if zero_fill_events or not fill_defaults:
        return _finish(flat, RAW_TRIP_UPDATES, fill_defaults)
    # keep absent arrival/departure values NULL while filling everything else
    keep_null = {f"{k}_{f}" for k in ("arrival", "departure") for f in ("delay", "time", "uncertainty")}
    cols = []
    for field in RAW_TRIP_UPDATES.fields:
        c = F.col(field.name).cast(field.dataType)
        d = None if field.name in keep_null else type_default(field.dataType)
        cols.append((F.coalesce(c, d) if d is not None else c).alias(field.name))
    return flat.select(*cols)
