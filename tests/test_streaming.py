import json

import pytest

from pyspark.sql import functions as F

from railyard.operators.flatten import flatten_trip_updates
from railyard.operators.latest import keep_latest
from railyard.schemas import RAW_TRIP_UPDATES
from railyard.session import scratch_path
from railyard.sources.raw import read_feed
from railyard.streaming.append import stream_raw
from railyard.sources.sinks import StreamManaged, append_raw
from railyard.sources import files, versions
from railyard.streaming import incremental
from railyard.streaming.incremental import merge_batch, read_current, stream_latest


def _snapshot(ts, delays):
    return {"header": {"gtfs_realtime_version": "2.0", "timestamp": ts},
            "entity": [{"id": "u1", "trip_update": {"trip": {"trip_id": "t1"}, "stop_time_update": [
                {"stop_sequence": i + 1, "arrival": {"delay": d}} for i, d in enumerate(delays)]}}]}


def test_stream_append_equals_batch(spark):
    landing = scratch_path(spark, "feed")
    for i, snap in enumerate([_snapshot(100, [1, 2]), _snapshot(160, [3]), _snapshot(220, [4, 5, 6])]):
        spark.createDataFrame([(json.dumps(snap),)], "value string").write.text(f"{landing}/f{i}")
    # stream every snapshot file as it lands, one file per micro-batch
    files = f"{landing}/*/*.txt"
    stamp = F.timestamp_micros(F.lit(1))

    def flat(df):
        return flatten_trip_updates(df, ingested_at=stamp)

    out, ckpt = scratch_path(spark, "raw"), scratch_path(spark, "ckpt")
    q = stream_raw(read_feed(spark, files, streaming=True, max_files_per_trigger=1), out, ckpt,
                   transform=flat, schema=RAW_TRIP_UPDATES)
    q.awaitTermination()
    counts = [p["observedMetrics"]["ingest"]["rows"] for p in q.recentProgress
              if p.get("observedMetrics", {}).get("ingest")]
    assert sorted(c for c in counts if c) == [1, 2, 3]  # one snapshot file per micro-batch
    streamed = sorted(map(tuple, spark.read.parquet(out).collect()))
    batch = sorted(map(tuple, flat(read_feed(spark, files)).collect()))
    assert streamed == batch and len(batch) == 6
    # a restart with the same checkpoint finds nothing new: no duplicates
    q2 = stream_raw(read_feed(spark, files, streaming=True), out, ckpt, transform=flat, schema=RAW_TRIP_UPDATES)
    q2.awaitTermination()
    assert spark.read.parquet(out).count() == 6


def _batch(spark, rows):
    return spark.createDataFrame(rows, "k string, day long, seq long, v string")


def test_incremental_merge_replaces_late_newer_copy_and_is_replay_safe(spark):
    target = scratch_path(spark, "latest")
    args = dict(keys=["k", "day"], order=["seq"], tie_breakers=[], bucket=F.col("day"))
    b0 = _batch(spark, [("a", 1, 1, "old"), ("b", 1, 1, "b"), ("c", 2, 1, "c")])
    b1 = _batch(spark, [("a", 1, 5, "new"), ("a", 1, 3, "mid")])
    merge_batch(b0, 0, target, **args)
    merge_batch(b1, 1, target, **args)
    first = sorted(map(tuple, read_current(spark, target).collect()))
    assert first == [("a", 1, 5, "new"), ("b", 1, 1, "b"), ("c", 2, 1, "c")]
    merge_batch(b1, 1, target, **args)  # replay of the same batch id
    merge_batch(b1, 2, target, **args)  # the same rows again under a new id
    assert sorted(map(tuple, read_current(spark, target).collect())) == first
    union = b0.unionByName(b1)
    assert sorted(map(tuple, keep_latest(union, ["k", "day"], ["seq"], []).collect())) == first


def test_stream_latest_equals_batch(spark):
    landing = scratch_path(spark, "land")
    rows = [(f"k{i % 7}", i % 3, i, f"v{i}") for i in range(60)]
    _batch(spark, rows).repartition(5).write.parquet(landing)
    src = spark.readStream.schema("k string, day long, seq long, v string") \
        .option("maxFilesPerTrigger", 1).parquet(landing)
    target, ckpt = scratch_path(spark, "t"), scratch_path(spark, "c")
    stream_latest(src, target, ckpt, ["k", "day"], ["seq"], [], F.col("day")).awaitTermination()
    expect = keep_latest(_batch(spark, rows), ["k", "day"], ["seq"], [])
    assert sorted(map(tuple, read_current(spark, target).collect())) == sorted(map(tuple, expect.collect()))


def test_incremental_silver_equals_batch_silver(spark):
    import datetime as dt

    from railyard.plans.silver import silver_vehicle_positions
    from railyard.schemas import RAW_VEHICLE_POSITIONS
    from railyard.streaming.incremental import stream_silver_positions
    from tests.test_plans import dims
    from tests.conftest import rows_df

    base = dt.datetime(2023, 11, 14, 22, 0, 0)
    rows = [dict(entity_id=f"e{i % 4}", feed_timestamp=1_700_000_000 + 30 * (i % 3), vehicle_id=f"v{i % 4}",
                 route_id="r1", stop_id="s1", trip_id="t1", speed=float(i),
                 ingested_at=base + dt.timedelta(seconds=i)) for i in range(24)]
    landing = scratch_path(spark, "raw-land")
    rows_df(spark, RAW_VEHICLE_POSITIONS, rows).repartition(4).write.parquet(landing)
    src = spark.readStream.schema(RAW_VEHICLE_POSITIONS).option("maxFilesPerTrigger", 1).parquet(landing)
    target, ckpt = scratch_path(spark, "slv"), scratch_path(spark, "slv-ckpt")
    stream_silver_positions(src, target, ckpt).awaitTermination()
    routes, stops, trips = dims(spark)
    inc = silver_vehicle_positions(read_current(spark, target), routes, stops, trips, deduplicated=True)
    batch = silver_vehicle_positions(spark.read.parquet(landing), routes, stops, trips)
    assert sorted(map(tuple, inc.collect())) == sorted(map(tuple, batch.collect()))
    assert batch.count() == 12


def test_stream_append_date_partitioned(spark):
    landing = scratch_path(spark, "feed-dp")
    snaps = [_snapshot(1_700_000_000, [1, 2]), _snapshot(1_700_000_000 + 86400, [3])]
    for i, snap in enumerate(snaps):
        spark.createDataFrame([(json.dumps(snap),)], "value string").write.text(f"{landing}/f{i}")
    out, ckpt = scratch_path(spark, "raw-dp"), scratch_path(spark, "ckpt-dp")
    stream_raw(read_feed(spark, f"{landing}/*/*.txt", streaming=True), out, ckpt,
               transform=flatten_trip_updates, schema=RAW_TRIP_UPDATES, date_partitioned=True).awaitTermination()
    back = spark.read.parquet(out)
    got = sorted((str(r.feed_date), r.stop_sequence) for r in back.collect())
    assert got == [("2023-11-14", 1), ("2023-11-14", 2), ("2023-11-15", 1)]


def test_storage_is_bounded_by_the_kept_versions(spark, monkeypatch):
    monkeypatch.setattr(incremental, "VACUUM_EVERY", 1)
    target = scratch_path(spark, "kept")
    args = dict(keys=["k", "day"], order=["seq"], tie_breakers=[], bucket=F.col("day"), keep=2)
    for i in range(6):
        merge_batch(_batch(spark, [("a", 1, i, f"v{i}"), ("b", i, i, "x")]), i, target, **args)
    # the versions kept at the last merge, and the one it made
    assert [v.number for v in versions.history(spark, target)] == [4, 5, 6]
    batches = files.children(spark, f"{target}/data")
    live = {r[0] for v in versions.history(spark, target) for r in versions.manifest_of(spark, target, v).select("__batch").collect()}
    assert {b.removeprefix("__batch=") for b in batches} == live
    got = sorted(map(tuple, read_current(spark, target).collect()))
    assert got == sorted([("a", 1, 5, "v5")] + [("b", i, i, "x") for i in range(6)])
    before = versions.history(spark, target)[0]
    assert ("a", 1, 3, "v3") in [tuple(r) for r in read_current(spark, target, before).collect()]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_row = st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 2), st.integers(0, 9),
                 st.sampled_from(["x", "y"]))


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches=st.lists(st.lists(_row, min_size=1, max_size=6), min_size=1, max_size=3),
       replays=st.lists(st.integers(0, 2), max_size=2))
def test_incremental_merge_equals_batch_under_replays(spark, batches, replays):
    target = scratch_path(spark, "prop")
    args = dict(keys=["k", "day"], order=["seq"], tie_breakers=["v"], bucket=F.col("day"))
    for i, rows in enumerate(batches):
        merge_batch(_batch(spark, rows), i, target, **args)
        if i in replays:  # at-least-once: the same batch id delivered again
            merge_batch(_batch(spark, rows), i, target, **args)
    every = _batch(spark, [r for rows in batches for r in rows])
    expect = sorted(map(tuple, keep_latest(every, ["k", "day"], ["seq"], ["v"]).collect()))
    assert sorted(map(tuple, read_current(spark, target).collect())) == expect


STEPS = ["write_batch", "entries", "manifest", "record", "after"]


@pytest.mark.parametrize("step", STEPS)
def test_a_crash_at_any_step_keeps_the_old_version_whole_and_is_replayed(spark, monkeypatch, step):
    target = scratch_path(spark, f"crash-{step}")
    args = dict(keys=["k", "day"], order=["seq"], tie_breakers=[], bucket=F.col("day"))
    merge_batch(_batch(spark, [("a", 1, 1, "old"), ("b", 1, 1, "b"), ("c", 2, 1, "c")]), 0, target, **args)
    old = [("a", 1, 1, "old"), ("b", 1, 1, "b"), ("c", 2, 1, "c")]
    new = [("a", 1, 5, "new"), ("b", 1, 1, "b"), ("c", 2, 1, "c")]
    late = _batch(spark, [("a", 1, 5, "new")])
    name = {"manifest": "manifest_of", "record": "_record", "after": "_record"}.get(step, step)
    real = getattr(versions, name)

    def dies(*a, **kw):
        if step == "after" or step == "write_batch":
            real(*a, **kw)  # the step is done, then the driver dies
        raise OSError(step)

    if step == "manifest":
        monkeypatch.setattr(versions, "publish", lambda *a, **kw: dies())
    else:
        monkeypatch.setattr(versions, name, dies)
    with pytest.raises(OSError):
        merge_batch(late, 1, target, **args)
    monkeypatch.undo()
    seen = sorted(map(tuple, read_current(spark, target).collect()))
    assert seen == (new if step == "after" else old)
    merge_batch(late, 1, target, **args)  # the restarted query replays batch 1
    assert sorted(map(tuple, read_current(spark, target).collect())) == new
    assert versions.current(spark, target).number == 2
    versions.vacuum(spark, target, keep=1)
    assert sorted(map(tuple, read_current(spark, target).collect())) == new
    assert len(files.children(spark, f"{target}/data")) == 2  # day 1 from batch 1, day 2 from batch 0


def test_readers_between_stage_and_publish_see_the_old_version(spark):
    target = scratch_path(spark, "between")
    args = dict(keys=["k", "day"], order=["seq"], tie_breakers=[])
    merge_batch(_batch(spark, [("a", 1, 1, "old"), ("b", 1, 1, "b")]), 0, target, bucket=F.col("day"), **args)
    opened = read_current(spark, target)
    base = versions.current(spark, target)
    late = _batch(spark, [("a", 1, 5, "new")]).withColumn("__bucket", F.col("day"))
    staged = incremental.stage_batch(late, target, base=base, **args)
    old = [("a", 1, 1, "old"), ("b", 1, 1, "b")]
    assert sorted(map(tuple, read_current(spark, target).collect())) == old
    incremental.publish_batch(spark, target, staged, "batch", 1)
    assert sorted(map(tuple, read_current(spark, target).collect())) == [("a", 1, 5, "new"), ("b", 1, 1, "b")]
    # a reader that was opened before, and one that asks for the old version
    assert sorted(map(tuple, opened.collect())) == old
    assert sorted(map(tuple, read_current(spark, target, base).collect())) == old


def test_two_writers_are_told_apart(spark):
    target = scratch_path(spark, "writers")
    args = dict(keys=["k", "day"], order=["seq"], tie_breakers=[])
    first = incremental.stage_batch(_batch(spark, [("a", 1, 1, "x")]).withColumn("__bucket", F.col("day")), target, base=None, **args)
    other = incremental.stage_batch(_batch(spark, [("b", 1, 1, "y")]).withColumn("__bucket", F.col("day")), target, base=None, **args)
    incremental.publish_batch(spark, target, first, "one", 0)
    with pytest.raises(versions.ConcurrentWriters):
        incremental.publish_batch(spark, target, other, "two", 0)


def test_null_and_negative_buckets(spark):
    target = scratch_path(spark, "odd")
    args = dict(keys=["k", "day"], order=["seq"], tie_breakers=[], bucket=F.col("day"))
    merge_batch(_batch(spark, [("a", None, 1, "x"), ("b", -5, 1, "y")]), 0, target, **args)
    merge_batch(_batch(spark, [("a", None, 2, "z"), ("c", None, 1, "w")]), 1, target, **args)
    got = sorted(map(tuple, read_current(spark, target).collect()), key=str)
    assert got == sorted([("a", None, 2, "z"), ("c", None, 1, "w"), ("b", -5, 1, "y")], key=str)


def test_retention_equals_the_batch_window(spark):
    """Buckets beyond the window leave; one that straddles it is cut on read; late rows beyond it are counted."""
    target, hour = scratch_path(spark, "window"), 3600
    args = dict(keys=["k", "day"], order=["seq"], tie_breakers=[], bucket=F.col("day") - F.pmod("day", F.lit(hour)),
                event_time="day", retain_seconds=2 * hour)
    batches = [[("a", 100, 1, "old"), ("b", 4000, 1, "b"), ("n", None, 1, "null")],
               [("c", 2 * hour + 50, 1, "c"), ("cut", 2 * hour + 10, 1, "cut"), ("b", 4000, 2, "b2")],
               [("d", 3 * hour + 500, 1, "d"), ("late", 10, 9, "too late")],
               [("late", 20, 9, "only late rows")],
               [("e", 4 * hour + 40, 1, "e")]]
    every = []
    for i, rows in enumerate(batches):
        every += rows
        merge_batch(_batch(spark, rows), i, target, **args)
        newest = max(r[1] for r in every if r[1] is not None)
        kept = [r for r in every if r[1] is not None and r[1] >= newest - 2 * hour]
        want = keep_latest(_batch(spark, kept), ["k", "day"], ["seq"], [])
        assert sorted(map(tuple, read_current(spark, target).collect())) == sorted(map(tuple, want.collect()))
    assert [v.note["late"] for v in versions.history(spark, target)] == ["0", "0", "1", "0"]
    last = versions.manifest_of(spark, target, versions.current(spark, target))
    assert sorted(r["__bucket"] for r in last.collect()) == [2 * hour, 3 * hour, 4 * hour]
    versions.vacuum(spark, target, keep=1)
    left = [b for d in files.children(spark, f"{target}/data") for b in files.children(spark, f"{target}/data/{d}")]
    assert not any(b in ("__bucket=0", "__bucket=__HIVE_DEFAULT_PARTITION__") for b in left)


def test_empty_batches_change_nothing(spark):
    target = scratch_path(spark, "empty")
    args = dict(keys=["k", "day"], order=["seq"], tie_breakers=[], bucket=F.col("day"))
    merge_batch(_batch(spark, []), 0, target, **args)  # an empty first batch
    merge_batch(_batch(spark, [("a", 1, 1, "x")]), 1, target, **args)
    merge_batch(_batch(spark, []), 2, target, **args)  # an empty later batch
    assert [tuple(r) for r in read_current(spark, target).collect()] == [("a", 1, 1, "x")]


def test_two_checkpoints_on_one_target_lose_nothing(spark):
    """A second stream starts again at batch 0; its rows must not count as a replay."""
    schema = "k string, day long, seq long, v string"
    target, rows = scratch_path(spark, "two"), [[("a", 1, 1, "x")], [("b", 1, 2, "y"), ("a", 1, 3, "z")]]
    for part in rows:
        landing, ckpt = scratch_path(spark, "two-landing"), scratch_path(spark, "two-ckpt")
        _batch(spark, part).write.parquet(landing)
        stream_latest(spark.readStream.schema(schema).parquet(landing), target, ckpt, ["k", "day"], ["seq"], [],
                      F.col("day")).awaitTermination()
    assert sorted(map(tuple, read_current(spark, target).collect())) == [("a", 1, 3, "z"), ("b", 1, 2, "y")]


def test_many_buckets(spark):
    target = scratch_path(spark, "many")
    args = dict(keys=["k", "day"], order=["seq"], tie_breakers=[], bucket=F.col("day"))
    merge_batch(_batch(spark, [("a", d, 1, "old") for d in range(4)]), 0, target, **args)
    merge_batch(_batch(spark, [("a", d, 2, "new") for d in (1, 2, 3)]), 1, target, **args)
    assert sorted(r.v for r in read_current(spark, target).collect()) == ["new", "new", "new", "old"]


def test_batch_append_to_a_streamed_folder_is_refused(spark):
    landing, out = scratch_path(spark, "mixed-landing"), scratch_path(spark, "mixed")
    b = _batch(spark, [("a", 1, 1, "x")])
    b.write.parquet(landing)
    stream_raw(spark.readStream.schema(b.schema).parquet(landing), out, scratch_path(spark, "mixed-ckpt")).awaitTermination()
    with pytest.raises(StreamManaged):
        append_raw(b, out, b.schema)
    assert spark.read.parquet(out).count() == 1
