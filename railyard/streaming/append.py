"""Streaming append of raw rows (each new snapshot file -> raw table).

The Parquet file sink plus a checkpoint location gives exactly-once output:
a micro-batch's files become visible only when its entry is committed to the
sink's metadata log, so a restarted query neither loses nor repeats rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from railyard.operators.timeops import FEED_DATE, with_feed_date
from railyard.sources.sinks import conform


def stream_raw(stream: DataFrame, path: str, checkpoint: str,
               transform: Callable[[DataFrame], DataFrame] | None = None,
               schema: StructType | None = None,
               available_now: bool = True,
               processing_time: str = "1 minute",
               date_partitioned: bool = False) -> StreamingQuery:
    """Start a query appending ``transform(stream)`` (e.g. a flatten) to the
    raw folder ``path``, schema-enforced when ``schema`` is given.
    ``available_now`` drains what is there and stops (scheduled runs);
    otherwise it runs with a ``processing_time`` trigger."""
    df = transform(stream) if transform else stream
    if schema is not None:
        df = conform(df, schema)
    if date_partitioned:
        df = with_feed_date(df)
    # rows accepted per micro-batch: query.lastProgress["observedMetrics"]["ingest"]["rows"]
    df = df.observe("ingest", F.count(F.lit(1)).alias("rows"))
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    if date_partitioned:
        writer = writer.partitionBy(FEED_DATE)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
