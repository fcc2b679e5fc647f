import datetime as dt
import os

from railyard.plans.gold import gold_current_vehicle_positions
from railyard.plans.refresh import RefreshConfig, refresh
from railyard.plans.silver import silver_trip_updates, silver_vehicle_positions
from railyard.schemas import (
    GLD_CURRENT_VEHICLE_POSITIONS_COLUMNS,
    RAW_TRIP_UPDATES,
    RAW_VEHICLE_POSITIONS,
    ROUTES,
    SLV_TRIP_UPDATES_COLUMNS,
    SLV_VEHICLE_POSITIONS_COLUMNS,
    STOPS,
    TRIPS,
)
from tests.conftest import rows_df

NOW = 1_700_000_000
T1 = dt.datetime(2023, 11, 14, 22, 0, 0)
T2 = dt.datetime(2023, 11, 14, 22, 0, 30)


def dims(spark):
    routes = rows_df(spark, ROUTES, [dict(route_id="r1", route_short_name="R1", route_long_name="Route one",
                                          route_type=3)])
    stops = rows_df(spark, STOPS, [dict(stop_id="s1", stop_name="Stop one", stop_lat=-27.5, stop_lon=153.0),
                                   dict(stop_id="s2", stop_name="Stop two")])
    trips = rows_df(spark, TRIPS, [dict(trip_id="t1", trip_headsign="Town", direction_id=1)])
    return routes, stops, trips


def positions(spark, rows):
    base = dict(entity_id="e1", feed_timestamp=NOW, trip_id="t1", route_id="r1", vehicle_id="v1",
                stop_id="s1", speed=10.0, vehicle_timestamp=NOW - 5, ingested_at=T1)
    return rows_df(spark, RAW_VEHICLE_POSITIONS, [{**base, **r} for r in rows])


def updates(spark, rows):
    base = dict(entity_id="u1", feed_timestamp=NOW, trip_id="t1", route_id="r1", vehicle_id="v1",
                trip_delay=45, stop_sequence=1, stop_id="s1", arrival_delay=30, departure_delay=0,
                ingested_at=T1)
    return rows_df(spark, RAW_TRIP_UPDATES, [{**base, **r} for r in rows])


def test_silver_positions(spark):
    raw = positions(spark, [dict(speed=5.0, ingested_at=T1), dict(speed=12.3, ingested_at=T2),
                            dict(entity_id="e2", route_id="zz", stop_id=None, speed=None)])
    out = silver_vehicle_positions(raw, *dims(spark))
    assert out.columns == SLV_VEHICLE_POSITIONS_COLUMNS
    rows = {r.entity_id: r for r in out.collect()}
    assert len(rows) == 2
    e1 = rows["e1"]
    assert (e1.speed_kmh, e1.route_long_name, e1.stop_name, e1.trip_headsign) == (44.3, "Route one", "Stop one", "Town")
    assert (e1.stop_latitude, e1.stop_longitude) == (-27.5, 153.0)
    assert e1.feed_time == dt.datetime.fromtimestamp(NOW, dt.timezone.utc).replace(tzinfo=None)
    e2 = rows["e2"]
    assert e2.speed_kmh is None and e2.route_long_name is None and e2.stop_name is None


def test_silver_window_applies_before_dedup(spark):
    raw = positions(spark, [dict(feed_timestamp=NOW - 7201), dict(feed_timestamp=NOW)])
    out = silver_vehicle_positions(raw, *dims(spark), window_seconds=7200, as_of=NOW)
    assert [r.feed_timestamp for r in out.collect()] == [NOW]


def test_silver_trip_updates(spark):
    raw = updates(spark, [dict(stop_sequence=1, arrival_delay=None, departure_delay=400),
                          dict(stop_sequence=2, stop_id="s2", arrival_delay=-90),
                          dict(stop_sequence=2, stop_id="s2", arrival_delay=-30, ingested_at=T2)])
    out = silver_trip_updates(raw, *dims(spark))
    assert out.columns == SLV_TRIP_UPDATES_COLUMNS
    got = sorted((r.stop_sequence, r.delay_seconds, r.delay_category, r.stop_name) for r in out.collect())
    assert got == [(1, 400, "VERY_LATE", "Stop one"), (2, -30, "ON_TIME", "Stop two")]


def _silver(spark, vp_rows, tu_rows):
    routes, stops, trips = dims(spark)
    return (silver_vehicle_positions(positions(spark, vp_rows), routes, stops, trips),
            silver_trip_updates(updates(spark, tu_rows), routes, stops, trips))


def test_gold_current_state(spark):
    vp, tu = _silver(spark,
                     [dict(feed_timestamp=NOW - 60), dict(entity_id="e9", feed_timestamp=NOW),
                      dict(entity_id="old", vehicle_id="v2", feed_timestamp=NOW - 901)],
                     [dict(stop_sequence=s, arrival_delay=d) for s, d in ((1, 10), (2, 90), (3, 400))])
    gold = gold_current_vehicle_positions(vp, tu, as_of=NOW)
    assert gold.columns == GLD_CURRENT_VEHICLE_POSITIONS_COLUMNS
    rows = gold.collect()
    assert len(rows) == 1  # v2 is older than the freshness window
    r = rows[0]
    assert (r.entity_id, r.trip_delay, r.delay_seconds, r.delay_category) == ("e9", 45, 10, "ON_TIME")


def test_gold_blank_keys(spark):
    vp, tu = _silver(spark,
                     [dict(entity_id="a", vehicle_id="", trip_id=""), dict(entity_id="b", vehicle_id="", trip_id="")],
                     [dict(trip_id="", arrival_delay=500)])
    parity = gold_current_vehicle_positions(vp, tu, as_of=NOW).collect()
    assert len(parity) == 1 and parity[0].delay_seconds == 500  # blank ids collapse and match
    assert gold_current_vehicle_positions(vp, tu, as_of=NOW, drop_blank_keys=True).count() == 0


def test_refresh_end_to_end(spark, tmp_dir):
    root = tmp_dir[len("file:"):] if tmp_dir.startswith("file:") else tmp_dir
    landing = f"{root}/landing"
    os.makedirs(landing)
    routes, stops, trips = dims(spark)
    for name, df in (("routes", routes), ("stops", stops), ("trips", trips)):
        df.toPandas().to_csv(f"{landing}/{name}.txt", index=False)
    positions(spark, [dict(), dict(ingested_at=T2, speed=3.0)]).write.parquet(f"{root}/raw_vp")
    updates(spark, [dict()]).write.parquet(f"{root}/raw_tu")
    out = refresh(spark, RefreshConfig(landing=landing, raw_positions=f"{root}/raw_vp",
                                       raw_trip_updates=f"{root}/raw_tu", out=f"{root}/out", as_of=NOW))
    assert out["slv_vehicle_positions"].count() == 1
    gold = out["gld_current_vehicle_positions"].collect()
    assert len(gold) == 1 and gold[0].speed == 3.0 and gold[0].delay_category == "ON_TIME"
    assert gold[0].route_long_name == "Route one"


def test_gold_reuses_trip_partitioning(spark, tmp_dir):
    vp, tu = _silver(spark, [dict()], [dict()])
    vp.write.parquet(f"{tmp_dir}/vp")
    tu.write.parquet(f"{tmp_dir}/tu")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        gold = gold_current_vehicle_positions(spark.read.parquet(f"{tmp_dir}/vp"),
                                              spark.read.parquet(f"{tmp_dir}/tu"), as_of=NOW)
        plan = gold._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # one exchange per ranking (vehicle_id, trip_id) and ONE more to bring the
    # positions to the trip partitioning; the delay side is reused as is
    assert plan.count("Exchange hashpartitioning") == 3
    assert "SortMergeJoin" in plan and plan.count("WindowGroupLimit") == 4
    assert "EvalPython" not in plan


def test_refresh_gold_prunes_silver_days(spark, tmp_dir):
    root = tmp_dir[len("file:"):] if tmp_dir.startswith("file:") else tmp_dir
    landing = f"{root}/landing"
    os.makedirs(landing)
    routes, stops, trips = dims(spark)
    for name, df in (("routes", routes), ("stops", stops), ("trips", trips)):
        df.toPandas().to_csv(f"{landing}/{name}.txt", index=False)
    positions(spark, [dict(feed_timestamp=NOW - d * 86400, entity_id=f"e{d}") for d in range(4)]) \
        .write.parquet(f"{root}/raw_vp")
    updates(spark, [dict()]).write.parquet(f"{root}/raw_tu")
    out = refresh(spark, RefreshConfig(landing=landing, raw_positions=f"{root}/raw_vp",
                                       raw_trip_updates=f"{root}/raw_tu", out=f"{root}/out", as_of=NOW))
    assert out["slv_vehicle_positions"].count() == 4
    gold = gold_current_vehicle_positions(out["slv_vehicle_positions"], out["slv_trip_updates"], as_of=NOW)
    plan = gold._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(feed_date" in plan
    assert [r.entity_id for r in gold.collect()] == ["e0"]


def test_silver_window_prunes_days_and_unused_columns(spark, tmp_dir):
    from railyard.sources.sinks import append_raw
    raw = positions(spark, [dict(feed_timestamp=NOW - d * 86400, entity_id=f"e{d}") for d in range(3)])
    append_raw(raw, tmp_dir, RAW_VEHICLE_POSITIONS, date_partitioned=True)
    out = silver_vehicle_positions(spark.read.parquet(tmp_dir), *dims(spark), window_seconds=7200, as_of=NOW)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(feed_date" in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "feed_date" in line][0]
    assert "license_plate" not in scan and "odometer" not in scan
    assert [r.entity_id for r in out.collect()] == ["e0"]


def test_jobs_entry_point_runs_collect_and_refresh(spark, tmp_dir, capsys):
    import json

    from railyard.jobs import main
    from tests.test_flatten import SNAPSHOT

    root = tmp_dir[len("file:"):] if tmp_dir.startswith("file:") else tmp_dir
    landing = f"{root}/landing"
    os.makedirs(landing)
    routes, stops, trips = dims(spark)
    for name, df in (("routes", routes), ("stops", stops), ("trips", trips)):
        df.toPandas().to_csv(f"{landing}/{name}.txt", index=False)
    snap = dict(SNAPSHOT, header=dict(SNAPSHOT["header"], timestamp=NOW))
    os.makedirs(f"{root}/feed")
    with open(f"{root}/feed/s1.json", "w") as fh:
        fh.write(json.dumps(snap) + "\n")
    for feed, raw in (("vehicle_positions", "raw_vp"), ("trip_updates", "raw_tu")):
        assert main(["collect", "--feed", feed, "--source", f"{root}/feed", "--raw", f"{root}/{raw}",
                     "--checkpoint", f"{root}/ckpt_{raw}"]) == 0
    assert main(["refresh", "--landing", landing, "--raw-positions", f"{root}/raw_vp",
                 "--raw-trip-updates", f"{root}/raw_tu", "--out", f"{root}/out", "--as-of", str(NOW)]) == 0
    printed = dict(line.split() for line in capsys.readouterr().out.splitlines() if line.count(" ") == 1)
    assert printed["slv_vehicle_positions"] == "1" and printed["slv_trip_updates"] == "3"
    assert printed["gld_current_vehicle_positions"] == "1"
