"""How much the larger derivations and merges shuffle, spill and write."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from railyard.plans import feed_standins as fq
from railyard.plans import transit_standins as tq
from railyard.plans.standins import nest_bounded
from railyard.schemas import ROUTES, STOPS, TRIPS
from railyard.sources import versions
from railyard.streaming import incremental

LINEITEM = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, "
            "l_linestatus string, l_shipdate timestamp_ntz")
ORDERS = "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"
DAY_1, DAY_2 = datetime(2024, 1, 1), datetime(2024, 1, 9)


def lines(spark, orders=20, a_order=4):
    li = [(o, 10 * o + n, n, n, float(n), "RN"[n % 2], "FO"[n % 2], DAY_2) for o in range(orders) for n in range(1, a_order + 1)]
    od = [(o, o % 7, DAY_1, "1-URGENT") for o in range(orders)]
    return spark.createDataFrame(li, LINEITEM), spark.createDataFrame(od, ORDERS), spark.createDataFrame([(DAY_2,)], "ts timestamp_ntz")


def test_partitions_of_raw_trip_updates_follow_the_copies(spark, monkeypatch):
    monkeypatch.setattr(tq, "ROWS_PER_TASK", 20)
    li, od, ev = lines(spark)
    raw = tq.raw_trip_updates_from_lines(li, od, ev, copies=5)
    assert raw.count() == 20 * 4 * 5
    assert raw.rdd.getNumPartitions() == 20 * 4 * 5 // 20


@pytest.mark.parametrize("few", [0, 64])
def test_a_merge_into_few_buckets_shuffles_its_rows_once(spark, tmp_dir, monkeypatch, few):
    plans, write = [], versions.write_batch

    def spy(rows, root, name=None, **kw):
        plans.append(bool(kw.get("rebalance", True)))
        return write(rows, root, name, **kw)

    monkeypatch.setattr(versions, "write_batch", spy)
    monkeypatch.setattr(incremental, "FEW_BUCKETS", few)
    how = dict(keys=["k"], order=["at"], tie_breakers=["v"], bucket=F.col("k") % 3)
    for batch, rows in enumerate(([(k, 1, k) for k in range(30)], [(k, 2, -k) for k in range(0, 30, 2)])):
        df = spark.createDataFrame(rows, "k long, at long, v long")
        incremental.merge_batch(df, batch, tmp_dir, **how)
    got = {tuple(r) for r in incremental.read_current(spark, tmp_dir).collect()}
    assert got == {(k, 1, k) if k % 2 else (k, 2, -k) for k in range(30)}
    assert plans == [few == 0] * 2  # only a merge into many buckets needs the second shuffle


def test_nested_chunks_are_bounded_and_only_large_keys_are_counted(spark):
    df = spark.createDataFrame([(k, v) for k, n in ((1, 3), (2, 900), (None, 5)) for v in range(n)], "k long, v long")
    nested = nest_bounded(df, ["k"], "vs", ["v"], max_items=100, finish=lambda e: e["v"] + F.col("k")).collect()
    assert sum(r.k == 1 for r in nested) == 1
    assert max(len(r.vs) for r in nested) < 200
    assert sorted((r.k, v) for r in nested for v in r.vs) == [(1, v + 1) for v in range(3)] + [(2, v + 2) for v in range(900)]


def test_trip_update_snapshots_are_written_compressed(spark, tmp_dir):
    li, od, _ = lines(spark)
    li.write.parquet(f"{tmp_dir}/lineitem.parquet")
    od.write.parquet(f"{tmp_dir}/orders.parquet")
    feed = fq.trip_update_feed(spark, tmp_dir)
    assert all(f.endswith(".json.gz") for f in feed.inputFiles())
    stops = feed.select("header.timestamp", F.explode("entity").alias("e")).select(
        "timestamp", "e.trip_update.trip.trip_id", F.explode("e.trip_update.stop_time_update").alias("s"))
    day = int(DAY_2.replace(tzinfo=timezone.utc).timestamp())
    mins = 8 * 60
    for r in stops.collect():
        n = r.s.stop_sequence
        assert (r.timestamp, r.s.stop_id) == (day, str(10 * int(r.trip_id[1:]) + n))
        assert (r.s.arrival is None) == (n % 2 == 0)  # returned lines don't arrive
        assert r.s.arrival is None or tuple(r.s.arrival) == (mins, day + mins, n)
        assert r.s.departure is None or tuple(r.s.departure) == (mins + 30, day + mins + 1800, n)
        assert (r.s.departure is None) == (n % 2 == 0)
    assert stops.count() == 80


def test_silver_joins_trips_before_the_names_of_routes_and_stops(spark):
    li, od, ev = lines(spark)
    i = dict(raw_tu=tq.raw_trip_updates_from_lines(li, od, ev), trips=spark.createDataFrame([], TRIPS),
             routes=spark.createDataFrame([], ROUTES), stops=spark.createDataFrame([], STOPS))
    plan = tq._silver_tu(i)._jdf.queryExecution().analyzed().toString()
    joins = [next(k for k in ("trip_id", "route_id", "stop_id") if f"({k}#" in row)
             for row in plan.splitlines() if "Join LeftOuter" in row]
    assert joins == ["stop_id", "route_id", "trip_id"]  # the outermost first
