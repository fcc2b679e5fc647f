import json


from railyard.functions.scalars import delay_category, delay_seconds
from railyard.operators.flatten import fill_defaults, flatten_trip_updates, flatten_vehicles, unnest
from railyard.schemas import RAW_TRIP_UPDATES, RAW_VEHICLE_POSITIONS
from railyard.sources.raw import read_feed
from tests.conftest import types

SNAPSHOT = {
    "header": {"gtfs_realtime_version": "2.0", "timestamp": 1700000000},
    "entity": [
        {"id": "v1", "vehicle": {
            "trip": {"trip_id": "t1", "route_id": "r1", "direction_id": 1, "schedule_relationship": 4},
            "vehicle": {"id": "bus-1", "label": "B1"},
            "position": {"latitude": -27.5, "longitude": 153.0, "speed": 10.0},
            "current_stop_sequence": 3, "stop_id": "s3", "timestamp": 1699999990}},
        {"id": "u1", "trip_update": {
            "trip": {"trip_id": "t1", "route_id": "r1"}, "vehicle": {"id": "bus-1"}, "delay": 45,
            "stop_time_update": [
                {"stop_sequence": 1, "stop_id": "s1", "arrival": {"delay": 30, "time": 1700000100}},
                {"stop_sequence": 2, "stop_id": "s2", "departure": {"delay": 400}},
                {"stop_sequence": 3, "stop_id": "s3", "schedule_relationship": 2}]}},
        {"id": "u2", "trip_update": {"trip": {"trip_id": "t2"}, "stop_time_update": []}},
        {"id": "u3", "trip_update": {"trip": {"trip_id": "t3"}}},
        {"id": "a1"},
    ],
}


def _feed(spark, tmp_dir, snapshots=(SNAPSHOT,)):
    spark.createDataFrame([(json.dumps(s),) for s in snapshots], "value string").write.text(tmp_dir)
    return read_feed(spark, tmp_dir)


def test_vehicle_flatten(spark, tmp_dir):
    out = flatten_vehicles(_feed(spark, tmp_dir))
    assert types(out.schema) == types(RAW_VEHICLE_POSITIONS)
    rows = out.collect()
    assert len(rows) == 1  # only the entity holding a vehicle
    r = rows[0]
    assert (r.entity_id, r.feed_timestamp, r.trip_id, r.vehicle_id, r.direction_id) == ("v1", 1700000000, "t1", "bus-1", 1)
    assert r.incrementality == "FULL_DATASET"
    assert r.schedule_relationship == "4"  # unknown number kept as text
    assert (r.current_status, r.occupancy_status, r.wheelchair_accessible) == ("IN_TRANSIT_TO", "EMPTY", "NO_VALUE")
    assert r.congestion_level == "UNKNOWN_CONGESTION_LEVEL"
    assert r.license_plate == "" and r.bearing == 0.0 and r.occupancy_percentage == 0
    assert r.speed == 10.0 and r.ingested_at is not None


def test_trip_update_flatten_zero_fill(spark, tmp_dir):
    out = flatten_trip_updates(_feed(spark, tmp_dir))
    assert types(out.schema) == types(RAW_TRIP_UPDATES)
    rows = sorted(out.collect(), key=lambda r: r.stop_sequence)
    assert [r.stop_sequence for r in rows] == [1, 2, 3]  # empty / missing lists yield nothing
    assert {r.entity_id for r in rows} == {"u1"} and {r.trip_delay for r in rows} == {45}
    assert rows[1].arrival_delay == 0 and rows[1].departure_delay == 400
    assert rows[2].stop_schedule_relationship == "NO_DATA"
    assert len({r.ingested_at for r in rows}) == 1  # one stamp per batch
    cats = [r[0] for r in out.orderBy("stop_sequence").select(
        delay_category(delay_seconds("arrival_delay", "departure_delay"))).collect()]
    assert cats == ["ON_TIME", "ON_TIME", "ON_TIME"]


def test_trip_update_flatten_keeps_absent_events_null(spark, tmp_dir):
    out = flatten_trip_updates(_feed(spark, tmp_dir), zero_fill_events=False).orderBy("stop_sequence")
    rows = out.collect()
    assert rows[1].arrival_delay is None and rows[1].departure_delay == 400
    assert rows[0].departure_time is None and rows[0].vehicle_label == ""
    cats = [r[0] for r in out.select(delay_category(delay_seconds("arrival_delay", "departure_delay"))).collect()]
    assert cats == ["ON_TIME", "VERY_LATE", "UNKNOWN"]


def test_unnest_and_fill_defaults(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, []), (3, None)], "id int, xs array<double>")
    assert unnest(df, "xs", "x", ["id"]).count() == 2
    assert unnest(df, "xs", "x", ["id"], outer=True).count() == 4
    pos = unnest(df, "xs", "x", ["id"], position="p").orderBy("p").collect()
    assert [(r.p, r.x) for r in pos] == [(0, 1.0), (1, 2.0)]
    filled = fill_defaults(spark.createDataFrame([(None, None)], "s string, n int")).collect()[0]
    assert (filled.s, filled.n) == ("", 0)


def test_flatten_is_narrow(spark, tmp_dir):
    plan = flatten_trip_updates(_feed(spark, tmp_dir))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" in plan
