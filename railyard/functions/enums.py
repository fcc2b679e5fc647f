"""Enum number -> name decoding (JVM-side CASE expressions, no lookups in Python).

Rule: an unset value takes the enum's declared default; a number the enum
does not know is kept as its decimal string.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Enum:
    name: str
    values: dict[int, str]
    default: int = 0


# GTFS-Realtime enumerations (number -> name) and the value an
# unset field reads as. They must equal the feed specification.
INCREMENTALITY = Enum("Incrementality", {
    0: "FULL_DATASET", 1: "DIFFERENTIAL",
}, default=0)
TRIP_SCHEDULE_RELATIONSHIP = Enum("TripDescriptor.ScheduleRelationship", {
    0: "SCHEDULED", 1: "ADDED", 2: "UNSCHEDULED", 3: "CANCELED", 5: "REPLACEMENT",
    6: "DUPLICATED", 7: "DELETED", 8: "NEW",
}, default=0)
STOP_SCHEDULE_RELATIONSHIP = Enum("StopTimeUpdate.ScheduleRelationship", {
    0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA", 3: "UNSCHEDULED",
}, default=0)
VEHICLE_STOP_STATUS = Enum("VehicleStopStatus", {
    0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO",
}, default=2)
CONGESTION_LEVEL = Enum("CongestionLevel", {
    0: "UNKNOWN_CONGESTION_LEVEL", 1: "RUNNING_SMOOTHLY", 2: "STOP_AND_GO", 3: "CONGESTION",
    4: "SEVERE_CONGESTION",
}, default=0)
OCCUPANCY_STATUS = Enum("OccupancyStatus", {
    0: "EMPTY", 1: "MANY_SEATS_AVAILABLE", 2: "FEW_SEATS_AVAILABLE", 3: "STANDING_ROOM_ONLY",
    4: "CRUSHED_STANDING_ROOM_ONLY", 5: "FULL", 6: "NOT_ACCEPTING_PASSENGERS",
    7: "NO_DATA_AVAILABLE", 8: "NOT_BOARDABLE",
}, default=0)
WHEELCHAIR_ACCESSIBLE = Enum("WheelchairAccessible", {
    0: "NO_VALUE", 1: "UNKNOWN", 2: "WHEELCHAIR_ACCESSIBLE", 3: "WHEELCHAIR_INACCESSIBLE",
}, default=0)

ALL_ENUMS = [
    INCREMENTALITY, TRIP_SCHEDULE_RELATIONSHIP, STOP_SCHEDULE_RELATIONSHIP, VEHICLE_STOP_STATUS,
    CONGESTION_LEVEL, OCCUPANCY_STATUS, WHEELCHAIR_ACCESSIBLE,
]


def enum_name(col: Column | str, enum: Enum, fill_unset: bool = True) -> Column:
    """Decode an enum number column to its name.

    ``fill_unset`` applies the enum's default to NULL (an unset field);
    without it NULL stays NULL.
    """
    c = F.col(col) if isinstance(col, str) else col
    if fill_unset:
        c = F.coalesce(c, F.lit(enum.default))
    expr = None
    for number, label in enum.values.items():
        expr = (F.when(c == number, F.lit(label)) if expr is None
                else expr.when(c == number, F.lit(label)))
    return expr.otherwise(c.cast("string"))
