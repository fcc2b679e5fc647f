"""Streaming append to a table of published versions, with a ledger of its batches and compaction.

The file sink's log (``streaming.append``) can't be compacted from outside. Here every micro-batch is a folder and a
published version (``sources.versions``): a batch that is replayed after its version was published is left alone, so
rows are appended exactly once. One row of the ledger per batch says how many rows it brought; ``ledger`` returns each
batch once, however often it was tried.

A feed polled each minute makes some 1,440 small batches a day. Every ``compact_every`` batches the query rewrites
the buckets (days) that hold several batches into few files; that is one more version, so readers see the same rows
before and after, and those who resolved an older version can still read it until ``vacuum``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from railyard.sources import versions
from railyard.sources.sinks import conform
from railyard.sources.versions import BATCH, PART, Version
from railyard.streaming.incremental import query_id

DAY = 86400
COMPACT_EVERY = 64
_LEDGER = "query string, batch_id long, rows long, version long"


def _day_bucket(event_time: str) -> Column:
    return F.floor(F.col(event_time) / DAY).cast("long")


def append_batch(batch: DataFrame, batch_id: int, target: str, owner: str, event_time: str | None = None,
                 compact_every: int = COMPACT_EVERY, keep: int = versions.KEEP) -> Version | None:
    """Append one micro-batch; returns the version that holds it (None: nothing was ever appended)."""
    spark = batch.sparkSession
    base = versions.current(spark, target)
    if base is not None and base.applied.get(owner, -1) >= batch_id:
        return base
    if base is not None and base.number % compact_every == 0:
        base = compact(spark, target) or base
        versions.vacuum(spark, target, keep)
    bucket = _day_bucket(event_time) if event_time else F.lit(0).cast("long")
    name = versions.write_batch(batch.withColumn(PART, bucket), target, f"{owner}-{batch_id}")
    schema = StructType([StructField(f.name, f.dataType) for f in batch.schema.fields])
    fresh = versions.entries(spark, target, name, schema, event_time)
    rows = fresh.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    number = base.number + 1 if base else 1
    spark.createDataFrame([(owner, batch_id, rows, number)], _LEDGER).coalesce(1).write.mode("append").parquet(f"{target.rstrip('/')}/ledger")
    return versions.publish(spark, target, base, None, fresh, schema, event_time, applied=(owner, batch_id),
                            note={"rows": str(rows)}, horizon=base.horizon if base else None)


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """(query, batch_id, rows) of every appended batch. A try that failed before its version was published is not
    counted until the batch is there."""
    now = versions.current(spark, target)
    rows = spark.read.schema(_LEDGER).parquet(f"{target.rstrip('/')}/ledger")
    done = spark.createDataFrame(list((now.applied if now else {}).items()) or [], "query string, last long")
    # the tries of one batch hold the same rows
    tries = rows.groupBy("query", "batch_id").agg(F.max("rows").alias("rows"))
    return tries.join(done, "query").where("batch_id <= last").drop("last")


def compact(spark: SparkSession, target: str, at_least: int = 2) -> Version | None:
    """Rewrite the buckets that hold ``at_least`` so many batches, in files of about the advisory partition size.
    Returns the new version, or None if there was nothing to do. Only the writer may call it, between two batches."""
    base = versions.current(spark, target)
    if base is None:
        return None
    manifest = versions.manifest_of(spark, target, base)
    many = manifest.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= at_least).select(PART)
    picked = manifest.alias("m").join(many.alias("s"), F.col(f"m.{PART}").eqNullSafe(F.col(f"s.{PART}")), "left_semi")
    n, n_rows = picked.agg(F.count(F.lit(1)), F.sum("rows")).first()
    if not n:
        return None
    name = versions.write_batch(versions.rows_of(spark, target, base, picked), target, "compacted")
    fresh = versions.entries(spark, target, name, base.schema, base.event_time)
    written = fresh.agg(F.sum("rows")).first()[0]
    if base.horizon is None and written != n_rows:
        raise RuntimeError(f"{target}: compaction read {n_rows} rows and wrote {written}")
    return versions.publish(spark, target, base, many, fresh, base.schema, base.event_time,
                            note={"compacted": str(n)}, horizon=base.horizon)


def batches_per_bucket(spark: SparkSession, target: str) -> DataFrame:
    """(__bucket, batches, rows) of the current version."""
    return versions.manifest_of(spark, target, versions.current(spark, target)).groupBy(PART).agg(
        F.count_distinct(BATCH).alias("batches"), F.sum("rows").alias("rows"))


def stream_append(stream: DataFrame, target: str, checkpoint: str,
                  transform: Callable[[DataFrame], DataFrame] | None = None, schema: StructType | None = None,
                  event_time: str | None = None, available_now: bool = True, processing_time: str = "1 minute",
                  compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Append ``transform(stream)`` to ``target``, schema-enforced when ``schema`` is given, in day buckets of
    ``event_time`` (POSIX seconds; none: one bucket)."""
    df = transform(stream) if transform else stream
    if schema is not None:
        df = conform(df, schema)

    def apply(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, batch_id, target, query_id(batch.sparkSession, checkpoint), event_time, compact_every)

    writer = df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
