"""Streaming operators run over the driver's tables.

The table is first landed as several files (a hash split of its rows, so the
copies of one key arrive in different micro-batches), then consumed by a
file-stream source one file per trigger, and drained with ``availableNow``.
Outputs equal their batch twins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.operators.flatten import flatten_vehicles
from railyard.plans.feed_standins import INGESTED_AT_MICROS, write_vehicle_snapshots
from railyard.plans.standins import DAY, events_as_positions, table
from railyard.plans.silver import silver_trip_updates, silver_vehicle_positions
from railyard.operators import slices
from railyard.plans.transit_standins import _inputs, as_epoch_micros, stored_slices
from railyard.schemas import RAW_VEHICLE_POSITIONS
from railyard.sources.raw import read_feed
from railyard.session import freed_shuffles, scratch_path
from railyard.operators.latest import POSITION_KEYS, TRIP_UPDATE_KEYS
from railyard.sources import versions
from railyard.streaming.append import stream_raw
from railyard.streaming.incremental import (
    merge_batch,
    publish_batch,
    read_current,
    stage_batch,
    stream_latest,
    stream_silver_positions,
    stream_silver_trip_updates,
)
from railyard.streaming.ledger import compact, ledger, stream_append
from railyard.streaming.stateful import late_report, stream_closed, with_open_keys

# a landing is consumed in about this many micro-batches
BATCHES = 4
ROWS_PER_FILE = 500_000


def land(df: DataFrame, path: str, by: str | None = None, at_least: int = BATCHES) -> int:
    """Write ``df`` to ``path`` as files of about ROWS_PER_FILE rows, ``at_least``
    so many (hash split on ``by``); returns the files to read per trigger.
    Without ``by``, many rows are written a trigger's files after the other."""
    with freed_shuffles(df.sparkSession):
        rows = df.count()
        files = max(at_least, -(-rows // ROWS_PER_FILE))
        per_trigger = -(-files // at_least)
        if by or rows <= slices.ROWS_PER_SLICE:
            (df.repartition(files, by) if by else df.repartition(files)).write.parquet(path)
        else:
            at = F.pmod(F.xxhash64(*df.columns), F.lit(at_least))
            for i in range(at_least):
                df.where(at == i).repartition(per_trigger).write.mode("append").option("compression", "zstd").parquet(path)
    return per_trigger


def _stream(spark: SparkSession, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    landing = scratch_path(spark, f"{name}-landing")
    per_trigger = land(df, landing, by)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_trigger).parquet(landing)


def _events_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _stream(spark, table(spark, sf_dir, "events"), name, by="event_id")


def q_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ckpt = scratch_path(spark, "stream-append"), scratch_path(spark, "stream-append-ckpt")
    q = stream_raw(_events_stream(spark, sf_dir, "stream-append"), out, ckpt)
    q.awaitTermination()
    return spark.read.parquet(out)


def q_stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = events_as_positions(_events_stream(spark, sf_dir, "stream-silver"))
    target, ckpt = scratch_path(spark, "stream-silver"), scratch_path(spark, "stream-silver-ckpt")
    q = stream_latest(stream, target, ckpt, ["user_id", "feed_timestamp"], ["ts"],
                      [F.col("event_id").desc()], bucket=F.col("feed_timestamp"))
    q.awaitTermination()
    return read_current(spark, target).select("event_id", "user_id", "feed_timestamp", "event_type", "value")


# hash buckets of a table without a time column: their number doesn't grow with the data
BUCKETS = 16


def q_stream_dedup_trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental keep-latest of lineitem copies per (order, line), bucketed
    by a hash of the order key; equals the batch de-duplication."""
    li = table(spark, sf_dir, "lineitem")
    stream = _stream(spark, li, "stream-lines", by="l_partkey")
    target, ckpt = scratch_path(spark, "stream-lines"), scratch_path(spark, "stream-lines-ckpt")
    bucket = F.pmod(F.xxhash64("l_orderkey"), F.lit(BUCKETS))
    q = stream_latest(stream, target, ckpt, ["l_orderkey", "l_linenumber"], ["l_shipdate"],
                      [F.col("l_partkey").desc(), F.col("l_suppkey").desc(), F.col("l_extendedprice").desc()],
                      bucket=bucket)
    q.awaitTermination()
    return read_current(spark, target).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def q_stream_feed_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collector path as a stream: vehicle snapshot files (built from
    events) -> file-stream source with the declared feed schema -> flatten ->
    schema-enforced append; equals the batch flatten of the same files."""
    snapshots = write_vehicle_snapshots(spark, sf_dir)
    stamp = F.timestamp_micros(F.lit(INGESTED_AT_MICROS))
    out, ckpt = scratch_path(spark, "stream-feed"), scratch_path(spark, "stream-feed-ckpt")
    q = stream_raw(read_feed(spark, snapshots, streaming=True, max_files_per_trigger=4), out, ckpt,
                   transform=lambda feed: flatten_vehicles(feed, ingested_at=stamp),
                   schema=RAW_VEHICLE_POSITIONS)
    q.awaitTermination()
    return as_epoch_micros(spark.read.parquet(out))


def q_stream_silver_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental silver on the real 27 raw columns; equals batch silver."""
    i = _inputs(spark, sf_dir)
    target, ckpt = scratch_path(spark, "slv-vp"), scratch_path(spark, "slv-vp-ckpt")
    stream_silver_positions(_stream(spark, i["raw_vp"], "slv-vp"), target, ckpt, bucket_seconds=30 * 86400).awaitTermination()
    return as_epoch_micros(silver_vehicle_positions(read_current(spark, target), i["routes"], i["stops"], i["trips"], deduplicated=True))


def q_stream_silver_trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental silver on the real 24 raw columns; equals batch silver."""
    i = _inputs(spark, sf_dir)
    target, ckpt = scratch_path(spark, "slv-tu"), scratch_path(spark, "slv-tu-ckpt")
    stream_silver_trip_updates(_stream(spark, i["raw_tu"], "slv-tu"), target, ckpt, bucket_seconds=365 * 86400).awaitTermination()
    return as_epoch_micros(stored_slices(spark, read_current(spark, target), TRIP_UPDATE_KEYS, lambda rows: silver_trip_updates(
        rows, i["routes"], i["stops"], i["trips"], deduplicated=True)))


def q_stream_silver_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental silver that keeps two days of event time; equals the batch window."""
    i = _inputs(spark, sf_dir)
    target, ckpt = scratch_path(spark, "slv-window"), scratch_path(spark, "slv-window-ckpt")
    stream_silver_positions(_stream(spark, i["raw_vp"], "slv-window"), target, ckpt, bucket_seconds=DAY,
                            retain_seconds=2 * DAY).awaitTermination()
    return as_epoch_micros(silver_vehicle_positions(read_current(spark, target), i["routes"], i["stops"], i["trips"],
                                                    deduplicated=True))


def q_versions_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see while a batch of newer copies of all events is merged: after it is staged (the old version,
    whole), after it is published (the new one), and the old version asked for by then."""
    ev = events_as_positions(table(spark, sf_dir, "events"))
    newer = ev.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR")).withColumn("value", F.col("value") + 1)
    target = scratch_path(spark, "isolated")
    how = dict(keys=["user_id", "feed_timestamp"], order=["ts"], tie_breakers=[F.col("event_id").desc()])
    old = merge_batch(ev, 0, target, bucket=F.col("feed_timestamp"), **how)
    staged = stage_batch(newer.withColumn(versions.PART, F.col("feed_timestamp")), target, base=old, **how)
    seen = {"staged": read_current(spark, target)}
    publish_batch(spark, target, staged, "batch", 1)
    seen["published"], seen["old"] = read_current(spark, target), read_current(spark, target, old)
    out = [df.select(F.lit(when).alias("seen"), "event_id", "user_id", "feed_timestamp", "value") for when, df in seen.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


SLICES = 4


def _in_time_order(spark: SparkSession, raw: DataFrame, name: str) -> tuple[DataFrame, int]:
    """A stream of ``raw`` in SLICES slices of event time, one a trigger, in which a copy stamped at an odd second comes
    a slice late; and the lateness that covers it."""
    landing, plain = scratch_path(spark, f"{name}-landing"), scratch_path(spark, f"{name}-raw")
    raw.write.parquet(plain)
    raw = spark.read.schema(raw.schema).parquet(plain)
    low, high = raw.agg(F.min("feed_timestamp"), F.max("feed_timestamp")).first()
    width = max(-(-(high - low + 1) // SLICES), 1)
    at = F.floor((F.col("feed_timestamp") - low) / width) + F.unix_seconds("ingested_at") % 2
    files = 0
    for i in range(SLICES + 1):  # one write after the other: the source reads files in the order they came
        files = max(files, land(raw.where(at == i), f"{landing}/slice={i}", "entity_id", at_least=1))
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", files).parquet(f"{landing}/*")
    return stream, 2 * width


def q_stream_stateful_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The real 27-column raw positions, de-duplicated by the state store; closed rows and open keys together equal
    the batch de-duplication."""
    raw = _inputs(spark, sf_dir)["raw_vp"]
    stream, lateness = _in_time_order(spark, raw, "stateful")
    out, ckpt = scratch_path(spark, "stateful"), scratch_path(spark, "stateful-ckpt")
    stream_closed(stream, out, ckpt, POSITION_KEYS, lateness_seconds=lateness).awaitTermination()
    return as_epoch_micros(with_open_keys(spark.read.parquet(out), raw, POSITION_KEYS))


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw positions, then, in a second run of the query, a copy of each: copies more than three days behind the
    newest one come too late."""
    raw = _inputs(spark, sf_dir)["raw_vp"]
    landing, out, ckpt = (scratch_path(spark, f"late-{name}") for name in ("landing", "out", "ckpt"))
    for i in range(2):
        land(raw, f"{landing}/copy={i}", "entity_id", at_least=1)
        stream = spark.readStream.schema(raw.schema).parquet(f"{landing}/*")
        stream_closed(stream, out, ckpt, POSITION_KEYS, lateness_seconds=3 * DAY).awaitTermination()
    return late_report(spark.read.parquet(out), spark.read.schema(raw.schema).parquet(f"{landing}/copy=0", f"{landing}/copy=1"))


def _appended(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Events appended in BATCHES micro-batches to a table of versions; returns its folder."""
    target, ckpt = scratch_path(spark, name), scratch_path(spark, f"{name}-ckpt")
    stream_append(events_as_positions(_events_stream(spark, sf_dir, name)), target, ckpt,
                  event_time="feed_timestamp").awaitTermination()
    return target


def q_stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the ledger of batches against the rows of the table."""
    target = _appended(spark, sf_dir, "ledger")
    rows = ledger(spark, target).agg(F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("ledger_rows"))
    return rows.crossJoin(versions.read_table(spark, target).agg(F.count(F.lit(1)).alias("table_rows")))  # one row each


def q_stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streamed rows after their small batches were rewritten, and how many batches a row's day had before."""
    target = _appended(spark, sf_dir, "compacted")
    before = versions.current(spark, target)
    compact(spark, target)
    small = versions.manifest_of(spark, target, before).groupBy(versions.PART).agg(F.sum("rows").alias("day_rows"))
    now = versions.current(spark, target)
    return versions.rows_of(spark, target, now).join(small, versions.PART).drop(versions.PART, "feed_timestamp")
