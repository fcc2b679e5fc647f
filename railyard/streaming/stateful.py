"""Keep-latest as a stateful stream: event-time watermark and state store.

For keys that hold the event time (the snapshot time is part of the natural
key), a streaming aggregation keeps the best copy of each key in the state
store. When the watermark passes a key's event time the row is emitted and
its state dropped, so state is bounded by the keys of the lateness window,
and no part of the output is ever rewritten (compare
``streaming.incremental``, which rewrites buckets but has every key at once).

The aggregate is ``min`` over a struct that sorts as ``keep_latest`` does:
the arrival stamp descending, then every other column ascending. Partial
aggregation collapses a hot key's copies in every task before the shuffle.

Copies that arrive after their key was emitted are dropped by the watermark
(Spark drops against the watermark of the batch before, so a copy may still be
merged one batch longer; it is never emitted twice).
``merged`` counts the copies behind each emitted row, so that
``late_report`` can tell exactly how many were dropped.

A row without an event time could never be emitted; it fails the query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import MapType, TimestampType

from railyard.operators.latest import keep_latest
from railyard.operators.timeops import FEED_DATE, with_feed_date

MERGED = "merged"
_EVENT, _BEST = "__event", "__best"
_LAST = 2 ** 63 - 1


def _best_first(df: DataFrame, keys: Sequence[str], arrival: str) -> Column:
    """Struct whose minimum is the row that ``keep_latest(keys, [arrival], "rest")`` keeps."""
    stamp = F.unix_micros(arrival) if isinstance(df.schema[arrival].dataType, TimestampType) else F.col(arrival).cast("long")
    rest = [f.name for f in df.schema.fields if f.name not in {*keys, arrival}]
    ordered = [c for c in rest if not isinstance(df.schema[c].dataType, MapType)]
    if len(ordered) < len(rest):
        raise TypeError("map columns have no order and cannot be kept")
    return F.struct(F.coalesce(-stamp, F.lit(_LAST)).alias("__latest_first"), *ordered, F.col(arrival))


def latest_in_window(stream: DataFrame, keys: Sequence[str], arrival: str, event_time: str,
                     lateness_seconds: int) -> DataFrame:
    """One row per key, with ``merged`` (its copies); on a stream a row is emitted once the newest event is
    ``lateness_seconds`` past its own."""
    if event_time not in keys:
        raise ValueError("the event time must be one of the keys: only then is a key closed by the watermark")
    missing = F.raise_error(F.lit(f"row without {event_time}")).cast("timestamp")
    event = F.coalesce(F.timestamp_seconds(event_time), missing)
    rows = stream.select("*", event.alias(_EVENT)).withWatermark(_EVENT, f"{lateness_seconds} seconds")
    best = rows.groupBy(*keys, _EVENT).agg(F.min(_best_first(stream, keys, arrival)).alias(_BEST),
                                           F.count(F.lit(1)).alias(MERGED))
    return best.select(*[F.col(c) if c in keys else F.col(f"{_BEST}.{c}").alias(c) for c in stream.columns], MERGED)


def stream_closed(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], arrival: str = "ingested_at",
                  event_time: str = "feed_timestamp", lateness_seconds: int = 7200, available_now: bool = True,
                  processing_time: str = "1 minute", date_partitioned: bool = False) -> StreamingQuery:
    """Append every closed key's row to ``path`` (exactly once: file sink and checkpoint)."""
    out = latest_in_window(stream, keys, arrival, event_time, lateness_seconds)
    if date_partitioned:
        out = with_feed_date(out)
    writer = out.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    if date_partitioned:
        writer = writer.partitionBy(FEED_DATE)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def with_open_keys(closed: DataFrame, raw: DataFrame, keys: Sequence[str], arrival: str = "ingested_at",
                   event_time: str = "feed_timestamp") -> DataFrame:
    """Closed rows and, de-duplicated on read, the raw rows newer than all of them: the keys that are still open.
    Only the raw rows of the lateness window are read (the bound reaches the scan)."""
    columns = [c for c in closed.columns if c in raw.columns]
    # nothing closed yet: every raw row is open
    newest = F.coalesce(closed.select(F.max(event_time)).scalar(), F.lit(-_LAST))
    tail = keep_latest(raw.select(columns).where(F.col(event_time) > newest), keys, [arrival], "rest")
    return closed.select(columns).unionByName(tail)


def late_report(closed: DataFrame, raw: DataFrame, event_time: str = "feed_timestamp") -> DataFrame:
    """One row: raw rows up to the newest closed event, how many of them were merged, and how many came too late."""
    newest = F.coalesce(closed.select(F.max(event_time)).scalar(), F.lit(-_LAST))
    seen = raw.where(F.col(event_time) <= newest).agg(F.count(F.lit(1)).alias("raw_rows"))
    merged = F.coalesce(closed.select(F.sum(MERGED)).scalar(), F.lit(0)).cast("long")
    return seen.select("raw_rows", merged.alias("merged_rows"), (F.col("raw_rows") - merged).alias("late_rows"))
