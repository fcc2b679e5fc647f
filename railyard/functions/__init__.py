"""Column -> Column helpers: enum decoding, speed, delay, epoch and time buckets."""

from railyard.functions.enums import enum_name
from railyard.functions.scalars import (
    bucket_start,
    classify,
    delay_category,
    delay_seconds,
    epoch_seconds,
    epoch_to_ts,
    now_epoch,
    speed_kmh,
)

__all__ = ["bucket_start", "classify", "delay_category", "delay_seconds", "enum_name", "epoch_seconds",
           "epoch_to_ts", "now_epoch", "speed_kmh"]
