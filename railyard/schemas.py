"""Declared schemas: raw fact tables, reference files, the nested feed, and
the ordered column lists of the derived tables.

Fixed values: table and column names, their order and types must equal the
transit tables the engine replaces, so they are written out plainly here.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S, I, L, F, D, TS = StringType(), IntegerType(), LongType(), FloatType(), DoubleType(), TimestampType()


def struct_schema(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# ── Fixed values: raw fact tables (one row per vehicle / per stop update) ──

RAW_VEHICLE_POSITIONS = struct_schema(
    ("entity_id", S), ("feed_timestamp", L), ("gtfs_realtime_version", S), ("incrementality", S),
    ("trip_id", S), ("route_id", S), ("direction_id", I), ("start_time", S), ("start_date", S),
    ("schedule_relationship", S), ("vehicle_id", S), ("vehicle_label", S), ("license_plate", S),
    ("wheelchair_accessible", S), ("latitude", F), ("longitude", F), ("bearing", F), ("odometer", D),
    ("speed", F), ("current_stop_sequence", I), ("stop_id", S), ("current_status", S),
    ("vehicle_timestamp", L), ("congestion_level", S), ("occupancy_status", S),
    ("occupancy_percentage", I), ("ingested_at", TS),
)

RAW_TRIP_UPDATES = struct_schema(
    ("entity_id", S), ("feed_timestamp", L), ("gtfs_realtime_version", S), ("incrementality", S),
    ("trip_id", S), ("route_id", S), ("direction_id", I), ("start_time", S), ("start_date", S),
    ("schedule_relationship", S), ("vehicle_id", S), ("vehicle_label", S), ("trip_delay", I),
    ("trip_timestamp", L), ("stop_sequence", I), ("stop_id", S), ("arrival_delay", I),
    ("arrival_time", L), ("arrival_uncertainty", I), ("departure_delay", I), ("departure_time", L),
    ("departure_uncertainty", I), ("stop_schedule_relationship", S), ("ingested_at", TS),
)

# ── Fixed values: reference (static timetable) files ──

AGENCY = struct_schema(
    ("agency_id", S), ("agency_name", S), ("agency_url", S), ("agency_timezone", S),
    ("agency_lang", S), ("agency_phone", S),
)
ROUTES = struct_schema(
    ("route_id", S), ("agency_id", S), ("route_short_name", S), ("route_long_name", S),
    ("route_desc", S), ("route_type", I), ("route_url", S), ("route_color", S), ("route_text_color", S),
)
STOPS = struct_schema(
    ("stop_id", S), ("stop_code", S), ("stop_name", S), ("stop_desc", S), ("stop_lat", D),
    ("stop_lon", D), ("zone_id", S), ("stop_url", S), ("location_type", I), ("parent_station", S),
    ("platform_code", S),
)
TRIPS = struct_schema(
    ("route_id", S), ("service_id", S), ("trip_id", S), ("trip_headsign", S), ("trip_short_name", S),
    ("direction_id", I), ("block_id", S), ("shape_id", S), ("wheelchair_accessible", I),
)
CALENDAR = struct_schema(
    ("service_id", S), ("monday", I), ("tuesday", I), ("wednesday", I), ("thursday", I),
    ("friday", I), ("saturday", I), ("sunday", I), ("start_date", S), ("end_date", S),
)
CALENDAR_DATES = struct_schema(("service_id", S), ("date", S), ("exception_type", I))

# dataset name -> (file name, schema); only these members of a delivery are loaded
REFERENCE_FILES: dict[str, tuple[str, StructType]] = {
    "agency": ("agency.txt", AGENCY),
    "routes": ("routes.txt", ROUTES),
    "stops": ("stops.txt", STOPS),
    "trips": ("trips.txt", TRIPS),
    "calendar": ("calendar.txt", CALENDAR),
    "calendar_dates": ("calendar_dates.txt", CALENDAR_DATES),
}

# ── Nested feed snapshot (header + repeated entity), enums as numbers ──

_TRIP = struct_schema(
    ("trip_id", S), ("route_id", S), ("direction_id", L), ("start_time", S), ("start_date", S),
    ("schedule_relationship", I),
)
_EVENT = struct_schema(("delay", I), ("time", L), ("uncertainty", I))
_STOP_TIME_UPDATE = struct_schema(
    ("stop_sequence", L), ("stop_id", S), ("schedule_relationship", I),
    ("arrival", _EVENT), ("departure", _EVENT),
)
_VEHICLE_POSITION = struct_schema(
    ("trip", _TRIP),
    ("vehicle", struct_schema(("id", S), ("label", S), ("license_plate", S), ("wheelchair_accessible", I))),
    ("position", struct_schema(("latitude", F), ("longitude", F), ("bearing", F), ("odometer", D), ("speed", F))),
    ("current_stop_sequence", L), ("stop_id", S), ("current_status", I), ("timestamp", L),
    ("congestion_level", I), ("occupancy_status", I), ("occupancy_percentage", L),
)
_TRIP_UPDATE = struct_schema(
    ("trip", _TRIP),
    ("vehicle", struct_schema(("id", S), ("label", S))),
    ("delay", I), ("timestamp", L),
    ("stop_time_update", ArrayType(_STOP_TIME_UPDATE)),
)
FEED = struct_schema(
    ("header", struct_schema(("gtfs_realtime_version", S), ("incrementality", I), ("timestamp", L))),
    ("entity", ArrayType(struct_schema(("id", S), ("vehicle", _VEHICLE_POSITION), ("trip_update", _TRIP_UPDATE)))),
)

# ── Fixed values: ordered output columns of the derived tables ──

SLV_VEHICLE_POSITIONS_COLUMNS = [
    "entity_id", "feed_timestamp", "feed_time",
    "trip_id", "route_id", "route_short_name", "route_long_name", "route_type", "trip_headsign",
    "direction_id", "start_time", "start_date", "schedule_relationship",
    "vehicle_id", "vehicle_label",
    "latitude", "longitude", "bearing", "speed", "speed_kmh",
    "current_stop_sequence", "stop_id", "stop_name", "stop_latitude", "stop_longitude", "current_status",
    "congestion_level", "occupancy_status", "vehicle_time", "ingested_at",
]

SLV_TRIP_UPDATES_COLUMNS = [
    "entity_id", "feed_timestamp", "feed_time",
    "trip_id", "route_id", "route_short_name", "route_long_name", "route_type", "trip_headsign",
    "direction_id", "start_time", "start_date", "schedule_relationship",
    "vehicle_id", "vehicle_label",
    "trip_delay",
    "stop_sequence", "stop_id", "stop_name", "arrival_delay", "arrival_time", "departure_delay",
    "departure_time", "stop_schedule_relationship",
    "delay_seconds", "delay_category", "ingested_at",
]

GLD_CURRENT_VEHICLE_POSITIONS_COLUMNS = SLV_VEHICLE_POSITIONS_COLUMNS + [
    "trip_delay", "delay_seconds", "delay_category",
]
