import pytest
from pyspark.sql import functions as F

from railyard.session import scratch_path
from railyard.sources import files, versions
from railyard.streaming import ledger as L

SCHEMA = "k string, t long"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows(spark, target):
    return sorted(map(tuple, versions.read_table(spark, target).collect()))


def test_batches_are_counted_once_and_replays_change_nothing(spark):
    target = scratch_path(spark, "led")
    L.append_batch(batch(spark, ("a", 10), ("b", 90_000)), 0, target, "q", "t")
    L.append_batch(batch(spark, ("c", 20)), 1, target, "q", "t")
    L.append_batch(batch(spark, ("c", 20)), 1, target, "q", "t")      # replay
    L.append_batch(batch(spark, ("d", 30)), 0, target, "other", "t")  # another query's batch 0
    L.append_batch(batch(spark), 1, target, "other", "t")
    assert rows(spark, target) == [("a", 10), ("b", 90_000), ("c", 20), ("d", 30)]
    got = sorted(map(tuple, L.ledger(spark, target).collect()))
    assert got == [("other", 0, 1), ("other", 1, 0), ("q", 0, 2), ("q", 1, 1)]


def test_a_failed_try_is_not_counted_before_its_replay(spark, monkeypatch):
    target = scratch_path(spark, "led-fail")
    L.append_batch(batch(spark, ("a", 10)), 0, target, "q", "t")
    real = versions.publish
    monkeypatch.setattr(versions, "publish", lambda *a, **kw: (_ for _ in ()).throw(OSError))
    with pytest.raises(OSError):
        L.append_batch(batch(spark, ("b", 20), ("c", 20)), 1, target, "q", "t")
    monkeypatch.setattr(versions, "publish", real)
    assert rows(spark, target) == [("a", 10)]
    assert [tuple(r) for r in L.ledger(spark, target).collect()] == [("q", 0, 1)]
    L.append_batch(batch(spark, ("b", 20), ("c", 20)), 1, target, "q", "t")
    assert sorted(map(tuple, L.ledger(spark, target).collect())) == [("q", 0, 1), ("q", 1, 2)]
    assert len(rows(spark, target)) == 3


def test_compaction_keeps_rows_and_old_readers(spark):
    target = scratch_path(spark, "led-compact")
    for i in range(5):
        L.append_batch(batch(spark, (f"k{i}", i), ("x", None), (f"z{i}", 86_400 * (1 + i // 4))), i, target, "q", "t")
    old = versions.read_table(spark, target)
    many = {r["__bucket"]: r.batches for r in L.batches_per_bucket(spark, target).collect()}
    assert many == {0: 5, None: 5, 1: 4, 2: 1}
    L.compact(spark, target)
    assert {r.batches for r in L.batches_per_bucket(spark, target).collect()} == {1}
    assert sorted(map(repr, old.collect())) == sorted(map(repr, versions.read_table(spark, target).collect()))
    assert L.compact(spark, target) is None
    L.append_batch(batch(spark, ("after", 5)), 5, target, "q", "t")
    assert versions.read_table(spark, target).count() == 16
    assert L.ledger(spark, target).agg(F.sum("rows")).first()[0] == 16
    versions.vacuum(spark, target, keep=1)
    assert versions.read_table(spark, target).count() == 16
    assert len(files.children(spark, f"{target}/data")) == 3  # the compacted one, day 2 of batch 4, batch 5


def test_the_stream_compacts_itself(spark):
    landing, target, ckpt = (scratch_path(spark, f"led-{n}") for n in ("landing", "out", "ckpt"))
    spark.range(60).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("t")).repartition(6).write.parquet(landing)
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landing)
    L.stream_append(src, target, ckpt, event_time="t", compact_every=2).awaitTermination()
    assert versions.read_table(spark, target).count() == 60
    assert L.batches_per_bucket(spark, target).first().batches < 6
    book = L.ledger(spark, target)
    assert book.count() == 6 and book.agg(F.sum("rows")).first()[0] == 60
