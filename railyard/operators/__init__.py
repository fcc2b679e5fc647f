"""DataFrame -> DataFrame operators: keep-latest, enrichment, time cut-offs, flattening."""

from railyard.operators.enrich import assert_unique_key, attach_latest, enrich, ref_routes, ref_stops, ref_trips
from railyard.operators.flatten import (
    fill_defaults,
    flatten_trip_updates,
    flatten_vehicles,
    has,
    stamp_ingested,
    unnest,
    zero_fill,
)
from railyard.operators.latest import (
    dedup_positions,
    dedup_trip_updates,
    keep_latest,
    latest_delay_per_trip,
    latest_per_vehicle,
)
from railyard.operators.timeops import cutoff, fresh, latest, rolling_window, with_feed_date

__all__ = [
    "assert_unique_key", "attach_latest", "cutoff", "dedup_positions", "dedup_trip_updates", "enrich",
    "fill_defaults", "flatten_trip_updates", "flatten_vehicles", "fresh", "has", "keep_latest", "latest",
    "latest_delay_per_trip", "latest_per_vehicle", "ref_routes", "ref_stops", "ref_trips", "rolling_window",
    "stamp_ingested", "unnest", "with_feed_date", "zero_fill",
]
