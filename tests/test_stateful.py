import datetime as dt

import pytest
from pyspark.sql import functions as F

from railyard.operators.latest import POSITION_KEYS, TRIP_UPDATE_KEYS, dedup_trip_updates, keep_latest
from railyard.schemas import RAW_TRIP_UPDATES, RAW_VEHICLE_POSITIONS
from railyard.session import scratch_path
from railyard.streaming.stateful import late_report, latest_in_window, stream_closed, with_open_keys
from tests.conftest import rows_df

BASE = 1_700_000_000
SCHEMA = "k string, t long, ingested_at timestamp, v string"


def stamp(seconds):
    return None if seconds is None else dt.datetime(2023, 11, 14) + dt.timedelta(seconds=seconds)


def batch(spark, rows):
    return spark.createDataFrame([(k, t, stamp(a), v) for k, t, a, v in rows], SCHEMA)


def run(spark, deliveries, lateness=100, **kw):
    """One run of the query per delivery; returns (closed, raw) tables."""
    landing, out, ckpt = (scratch_path(spark, f"st-{n}") for n in ("landing", "out", "ckpt"))
    for i, rows in enumerate(deliveries):
        batch(spark, rows).coalesce(1).write.parquet(f"{landing}/d{i}")
        src = spark.readStream.schema(SCHEMA).parquet(f"{landing}/*")
        stream_closed(src, out, ckpt, ["k", "t"], event_time="t", lateness_seconds=lateness, **kw).awaitTermination()
    return spark.read.parquet(out), spark.read.schema(SCHEMA).parquet(f"{landing}/*")


def test_closed_and_open_equal_batch_with_late_copies_inside_the_window(spark):
    deliveries = [[("a", BASE, 1, "x"), ("b", BASE, 1, "x"), ("a", BASE, 1, "w"), ("n", BASE, None, "null stamp")],
                  [("a", BASE, 5, "newer"), ("c", BASE + 90, 1, "c"), ("n", BASE, 0, "stamped")],
                  [("a", BASE, 3, "older"), ("d", BASE + 150, 1, None), ("d", BASE + 150, 1, "v")],
                  [("e", BASE + 400, 1, "e")]]
    closed, raw = run(spark, deliveries)
    want = sorted(map(tuple, keep_latest(raw, ["k", "t"], ["ingested_at"], "rest").collect()), key=str)
    got = with_open_keys(closed, raw, ["k", "t"], event_time="t")
    assert sorted(map(tuple, got.collect()), key=str) == want and len(want) == 6
    assert {r.k for r in closed.collect()} == {"a", "b", "c", "d", "n"}  # e is still open
    assert sum(r.merged for r in closed.collect()) == 10
    assert tuple(late_report(closed, raw, "t").first()) == (10, 10, 0)


def test_rows_beyond_the_window_are_counted(spark):
    deliveries = [[("a", BASE, 1, "x"), ("a", BASE, 2, "y"), ("b", BASE + 500, 1, "x")],
                  [("a", BASE, 9, "too late"), ("a", BASE, 10, "too late"), ("z", BASE + 1, 1, "new key, too late"),
                   ("c", BASE + 450, 1, "in time")],
                  [("end", BASE + 2000, 1, "x")]]
    closed, raw = run(spark, deliveries)
    assert sorted((r.k, r.v, r.merged) for r in closed.collect()) == [("a", "y", 2), ("b", "x", 1), ("c", "in time", 1)]
    assert tuple(late_report(closed, raw, "t").first()) == (7, 4, 3)


def test_state_is_dropped(spark):
    landing, out, ckpt = (scratch_path(spark, f"sd-{n}") for n in ("landing", "out", "ckpt"))
    kept = []
    for i in range(4):
        batch(spark, [(f"k{j}", BASE + 1000 * i, j, "v") for j in range(50)]).coalesce(1).write.parquet(f"{landing}/d{i}")
        q = stream_closed(spark.readStream.schema(SCHEMA).parquet(f"{landing}/*"), out, ckpt, ["k", "t"], event_time="t",
                          lateness_seconds=100)
        q.awaitTermination()
        kept.append([p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]][-1])
    assert kept == [50] * 4  # one snapshot's keys, however many have passed
    assert spark.read.parquet(out).count() == 150


def test_restart_repeats_nothing(spark):
    closed, raw = run(spark, [[("a", BASE, 1, "x"), ("b", BASE + 500, 1, "x")], [], []])
    assert [r.k for r in closed.collect()] == ["a"]


def test_date_partitioned_and_nothing_closed_yet(spark):
    closed, raw = run(spark, [[("a", BASE, 1, "x")]])
    assert closed.count() == 0
    assert [r.k for r in with_open_keys(closed, raw, ["k", "t"], event_time="t").collect()] == ["a"]
    assert tuple(late_report(closed, raw, "t").first()) == (0, 0, 0)


def test_keys_must_hold_the_event_time(spark):
    with pytest.raises(ValueError, match="event time"):
        latest_in_window(batch(spark, []), ["k"], "ingested_at", "t", 10)


def test_a_row_without_event_time_fails(spark):
    with pytest.raises(Exception, match="row without t"):
        latest_in_window(batch(spark, [("a", None, 1, "x")]), ["k", "t"], "ingested_at", "t", 10).collect()


@pytest.mark.parametrize("schema,keys", [(RAW_VEHICLE_POSITIONS, POSITION_KEYS), (RAW_TRIP_UPDATES, TRIP_UPDATE_KEYS)])
def test_order_equals_keep_latest_on_the_real_columns(spark, schema, keys):
    """Same winner as the batch ranking, ties and nulls included (the operator runs on batch tables too)."""
    rows = []
    for i in range(60):
        row = {f.name: None for f in schema.fields}
        row |= dict(entity_id=f"e{i % 3}", feed_timestamp=BASE + i % 2, trip_id=[None, "t", "s"][i % 3],
                    vehicle_label=["", None][i % 2], ingested_at=stamp([None, 5, 5, 7][i % 4]))
        if "stop_sequence" in row:
            row |= dict(stop_sequence=[None, 1][i % 2], arrival_delay=[None, -3, 4][i // 7 % 3])
        else:
            row |= dict(latitude=[None, float("nan"), 1.5][i // 5 % 3], bearing=float(i % 5))
        rows.append(row)
    df = rows_df(spark, schema, rows)
    got = latest_in_window(df, keys, "ingested_at", "feed_timestamp", 10)
    assert got.agg(F.sum("merged")).first()[0] == 60
    want = keep_latest(df, list(keys), ["ingested_at"], "rest")
    assert sorted(map(repr, map(tuple, got.drop("merged").collect()))) == sorted(map(repr, map(tuple, want.collect())))
    if "stop_sequence" in keys:
        assert want.count() == dedup_trip_updates(df).count()
