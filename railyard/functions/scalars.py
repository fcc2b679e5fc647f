"""Column -> Column helpers. All are built-in expressions (whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delay classification thresholds in seconds (upper bounds,
# inclusive) and their labels.
EARLY_THRESHOLD_SECS = -60
ON_TIME_THRESHOLD_SECS = 60
LATE_THRESHOLD_SECS = 300
DELAY_BANDS = [(EARLY_THRESHOLD_SECS, "EARLY"), (ON_TIME_THRESHOLD_SECS, "ON_TIME"), (LATE_THRESHOLD_SECS, "LATE")]
DELAY_ABOVE = "VERY_LATE"
DELAY_NULL = "UNKNOWN"

# Fixed value: metres per second -> kilometres per hour.
MS_TO_KMH = 3.6

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def speed_kmh(speed: Column | str, digits: int = 1) -> Column:
    """m/s -> km/h rounded HALF_UP to ``digits``; NULL stays NULL."""
    s = _c(speed)
    return F.when(s.isNotNull(), F.round(s * F.lit(MS_TO_KMH), digits))


def delay_seconds(arrival_delay: Column | str, departure_delay: Column | str) -> Column:
    """First non-null of the arrival and the departure delay."""
    return F.coalesce(_c(arrival_delay), _c(departure_delay))


def classify(value: Column | str, bands: Sequence[tuple[float, str]], above: str, null_label: str) -> Column:
    """Ordered threshold classification: the first band whose (inclusive)
    upper bound the value does not exceed; ``above`` past the last band and
    ``null_label`` for NULL."""
    v = _c(value)
    expr = F.when(v.isNull(), F.lit(null_label))
    for bound, label in bands:
        expr = expr.when(v <= F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(above))


def delay_category(delay: Column | str) -> Column:
    return classify(delay, DELAY_BANDS, DELAY_ABOVE, DELAY_NULL)


def epoch_to_ts(seconds: Column | str, ntz: bool = False) -> Column:
    """POSIX seconds -> timestamp. ``ntz=True`` gives a zone-free
    TIMESTAMP_NTZ (same wall clock as UTC), independent of the session zone."""
    s = _c(seconds)
    if ntz:
        return F.timestamp_add("SECOND", s, F.expr(_EPOCH_NTZ))
    return F.timestamp_seconds(s)


def epoch_micros_ntz(ts: Column | str) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ read as UTC."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(ts))


def epoch_seconds(ts: Column | str, ntz: bool = True) -> Column:
    """Floor of the POSIX seconds of a timestamp (exact integer arithmetic)."""
    if not ntz:
        return F.unix_seconds(_c(ts))
    us = epoch_micros_ntz(ts)
    return (floor_to(us, 1_000_000) / F.lit(1_000_000)).cast("bigint")


def floor_to(value: Column | str, step: int) -> Column:
    """Largest multiple of ``step`` not above ``value`` (integers, exact)."""
    v = _c(value)
    return v - F.pmod(v, F.lit(step))


def bucket_start(epoch: Column | str, seconds: int) -> Column:
    """Start (POSIX seconds) of the fixed ``seconds``-wide bucket holding ``epoch``."""
    return floor_to(epoch, seconds).cast("bigint")


def now_epoch(as_of: Column | int | None = None) -> Column:
    """Current POSIX seconds, or ``as_of`` when given (fixtures, replays)."""
    if as_of is None:
        return F.unix_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(int(as_of))
